from collections import Counter

from readweave.operators.reads import kmer_counts, kmer_histogram, kmer_places, low_complexity, motif_positions

SEQS = ["acgtacgtacgtacgtacgt" * 300, "acgtnnacgtACGTacgt", "ac", "", "acgtéacgt", "ggatcgatcc" * 40, None]


def reads_of(spark):
    return spark.createDataFrame(list(enumerate(SEQS)), "rid long, seq string")


def test_counts_with_other_letters(spark):
    for k in (1, 3, 5, 40):
        want = Counter(s[i : i + k] for s in SEQS if s for i in range(len(s) - k + 1))
        assert {r.kmer: r.n for r in kmer_counts(reads_of(spark), k).collect()} == {m: min(n, 255) for m, n in want.items()}
        assert {r.n: r.kmers for r in kmer_histogram(reads_of(spark), k).collect()} == Counter(min(n, 255) for n in want.values())


def test_tasks_count_before_they_send(spark):
    plan = kmer_places(reads_of(spark), 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.rindex("Exchange") and "explode" not in plan.split("MapInArrow")[0]


def test_places_and_windows_over_chunk_ends(spark):
    s = "a" * 61 + "gatc" + "t" * 4059 + "gatcgatc"
    reads = spark.createDataFrame([(1, s), (2, "acgt" * 2000), (3, "gat")], "rid long, seq string")
    want = [(r, i + 1) for r, t in ((1, s),) for i in range(len(t) - 3) if t[i : i + 4] == "gatc"]
    assert sorted((r.rid, r.pos) for r in motif_positions(reads, "DpnII").collect()) == want
    hit = set()
    for r, t in ((1, s), (2, "acgt" * 2000)):
        for w in range(0, len(t), 64):
            c = Counter(t[i : i + 3] for i in range(w, min(w + 62, len(t) - 2)))
            if sum(n * (n - 1) / 2 for n in c.values()) > 2.0 * 61:
                hit |= {(r, p) for p in range(w, min(w + 64, len(t)))}
    assert {(r.rid, p) for r in low_complexity(reads).collect() for p in range(r.beg, r.end_)} == hit
