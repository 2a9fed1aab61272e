from readweave.llm.lines import dedup_lines


def words(name, n):
    return " ".join(f"{name}{k}" for k in range(n))


def test_earliest_gram_in_other_surroundings(spark):
    """B and C share 60 words around a gram that stands earlier, in other surroundings, in A: C's repeat goes."""
    gram, own = words("g", 26), words("own", 34)
    rows = [(1, "\n".join([words("a", 40), gram, words("z", 40)])), (2, "\n".join([words("b", 9), gram, own])), (3, "\n".join([words("c", 9), gram, own]))]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: rows[1][1], 3: words("c", 9)}


def test_lines_after_a_window_that_stands_earlier(spark):
    """A has the first 50 words alone; the line that only B and C share after them goes too, and so does one before them."""
    x, y, z = words("x", 40), words("y", 10), words("z", 10)
    rows = [(1, f"{x}\n{y}\n{words('a', 5)}"), (2, f"{z}\n{x}\n{y}\n{z}"), (3, f"{z}\n{x}\n{y}\n{z}\n{words('c', 5)}")]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: f"{z}\n{z}", 3: words("c", 5)}
