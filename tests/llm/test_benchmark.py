"""Decontamination against a plain search for every window in every text."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

from readweave.llm import benchmark
from readweave.llm.benchmark import contamination, drop_contaminated, find_items

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def want(docs, items, size=10):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(len(w) - size + 1, 1)) if w else ():
            wins.setdefault(tuple(w[k : k + size]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, held = words(t), set(), set()
        for m in {len(x) for x in wins}:
            for k in range(len(w) - m + 1):
                found = wins.get(tuple(w[k : k + m]))
                if found:
                    hit |= set(range(k, k + m))
                    held |= found - {None}
        sha = hashlib.sha256(",".join(sorted(map(str, held))).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(held), sha, bool(hit)))
    return sorted(out, key=str)


def tables(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")


def cases(seed):
    r = random.Random(seed)
    some = ["a", "b", "the", "of", "Éa", "x1", "日本", "zed", "İ", "quill"]
    say = lambda n: r.choice([" ", ", ", "\n", "--"]).join(r.choice(some[: r.choice([2, 5, 10])]) for _ in range(n))
    items = [(k, say(r.choice([0, 1, 3, 9, 10, 11, 14, 30]))) for k in range(40)] + [(None, say(12)), (5, say(15)), (7, None), (100, items_text := say(20)), (101, items_text)]
    docs = [(k, say(r.choice([0, 1, 5, 9, 10, 50, 600]))) for k in range(60)]
    for k in range(40):
        t = r.choice(items)[1] or ""
        docs.append((100 + k, say(r.randrange(4)) + r.choice([" ", "", ". "]) + t.upper().replace(" ", "  ") + r.choice([" ", "é", "\t"]) + say(r.randrange(30))))
    return docs + [(None, "a"), (3, None), (3, ""), (3, "..."), (4, items[-1][1]), (4, items[-1][1])], items


@pytest.mark.parametrize("seed", range(4))
def test_same_as_brute_force(spark, seed):
    docs, items = cases(seed)
    items = [x for x in items if not words(x[1]) or len(words(x[1])) > (2 if seed else 0)]
    d, b = tables(spark, docs, items)
    assert sorted(map(tuple, contamination(d, b).collect()), key=str) == want(docs, items)


def test_several_sets_and_blocks_of_three(spark, monkeypatch):
    docs, items = cases(9)
    d, b = tables(spark, docs, items)
    assert sorted(map(tuple, contamination(d, b, most=60).collect()), key=str) == want(docs, items)
    monkeypatch.setattr(benchmark, "WIDE", 1)
    assert sorted(map(tuple, contamination(d, b, size=4).collect()), key=str) == want(docs, items, 4)


@pytest.mark.parametrize("piece", [50, 300])
def test_pieces_of_long_texts(monkeypatch, piece):
    monkeypatch.setattr(benchmark, "PIECE", piece)
    docs, items = cases(3)
    pairs = {(" ".join(w[k : k + 10]), str(i)) for i, t in items if i is not None and (w := words(t)) for k in range(max(len(w) - 9, 1))}
    search = benchmark.search_for(pa.table({"window": [p[0] for p in pairs], "item": [p[1] for p in pairs]}))
    text = " ".join(t or "" for _, t in docs) + " " + "y" * 1000 + " " + items[-1][1]
    n, spans, held = search.texts(pa.array([text]))
    (row,) = want([(0, text)], [x for x in items if x[0] is not None])
    assert (int(n[0]), sum(s["end"] - s["first"] for s in spans[0].as_py()), len(held[0])) == row[1:4]


def test_other_columns_empty_tables_and_long_texts(spark):
    item = " ".join(f"w{k}" for k in range(12))
    long = "river stone over and under the hills " * 140_000 + item
    docs = [(1, long, "v", 1), (2, "x" * 200_000, "v", 2), (3, item, None, 3), (None, None, "v", 4)]
    d = spark.createDataFrame(docs, "doc_id long, text string, n_words string, `row` int")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.row.row: r.out for r in find_items(d, b).collect()}
    assert [(x["first"], x["end"]) for x in got[1].spans] == [(980_000, 980_012)] and got[1]["items"] == ["1"]
    assert [r.row for r in drop_contaminated(d, b).orderBy("row").collect()] == [2, 4] and drop_contaminated(d, b).columns == d.columns
    assert contamination(d.limit(0), b).count() == 0
    assert not any(r.contaminated for r in contamination(d, b.limit(0)).collect())
