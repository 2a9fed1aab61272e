"""k-mers with their places go packed: against plain loops, with other letters, repeated reads and k-mers that fill most places."""

from collections import Counter

import pyarrow as pa

from readweave.operators.evidence import kmer_windows, self_seed_hits
from readweave.operators.letters import AT_ONCE, few_places, send_places
from readweave.operators.reads import cap_kmers, mask_kmers, seed_pairs
from readweave.plans import REGISTRY

SF = "/root/testdata/sf0.001"
SEQS = ["acgtacgtac" * 30, "acgtnnacgtACGTacgtacg", "ac", "", None, "ggatcgatcctta" * 3, "a" * 40_000 + "ggatcgatcc", "ttacgéacgtnnac", "cattagaca" + "a" * 9]
TURN = str.maketrans("acgt", "tgca")


def places(k):
    return [(r, i + 1, s[i : i + k]) for r, s in enumerate(SEQS) if s for i in range(len(s) - k + 1)]


def reads_of(spark):
    return spark.createDataFrame(list(enumerate(SEQS)), "rid long, seq string")


def test_rare_kmers(spark):
    for k, t in ((3, 4), (6, 3), (35, 2)):
        n = Counter(m for _, _, m in places(k))
        assert sorted(map(tuple, cap_kmers(reads_of(spark), k, t).collect())) == [x for x in sorted(places(k)) if n[x[2]] < t]


def test_seeds_on_both_strands(spark):
    k, cap = 5, 12
    here, turned = places(k), [(r, i + 1, s[i : i + k]) for r, s in ((r, s[::-1].translate(TURN)) for r, s in enumerate(SEQS) if s) for i in range(len(s) - k + 1)]
    n, m = Counter(x[2] for x in here), Counter(x[2] for x in turned)
    b = [(*x, 0) for x in here if n[x[2]] < cap] + [(*x, 1) for x in turned if m[x[2]] < cap]
    want = sorted((x[0], y[0], y[3], x[1], y[1]) for x in here if n[x[2]] < cap for y in b if x[2] == y[2] and x[0] < y[0])
    got = sorted((r.aread, r.bread, r.comp, r.apos, r.bpos) for r in seed_pairs(reads_of(spark), k, cap, both_strands=True).collect())
    assert want and got == want


def test_stretches_between_intervals(spark):
    iv = [(0, 10, 30), (0, 20, 40), (0, 40, 41), (0, 290, 300), (1, 0, 6), (6, 100, 39_000), (8, 500, 600), (99, 0, 5)]
    k = 4
    want = [x for x in places(k) if not any(r == x[0] and b < x[1] - 1 + k and e > x[1] - 1 for r, b, e in iv)]
    assert sorted(map(tuple, mask_kmers(reads_of(spark), spark.createDataFrame(iv, "rid long, beg long, end_ long"), k).collect())) == sorted(want)


def test_a_frequent_kmer_sends_no_more_than_its_limit():
    chunk = pa.RecordBatch.from_arrays([pa.array([7] * 9), pa.array(range(9)), pa.array(["a" * 30_013] * 9), pa.array([0] * 9, pa.int32())], ["rid", "_c", "_s", "strand"])
    sent = list(send_places(14, 30_000, 5, 3)([chunk]))
    assert AT_ONCE > 270_000 and sum(len(c) for b in sent for c in b.column("code").to_pylist()) == 5 * 4
    assert sum(b.num_rows for b in few_places(14, 5)(iter(sent))) == 0
    assert sum(b.num_rows for b in few_places(14, 6)(iter(sent))) == 5


def test_kmers_are_not_sent_as_rows(spark):
    for name in ("mask_kmers", "cap_kmers", "kmer_windows", "self_seed_hits", "seed_pairs"):
        plan = REGISTRY.queries[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "Repartition [" not in plan and "kmer" not in "".join(x for x in plan.splitlines() if "Repartition" in x), name


def test_windows_and_bands_of_other_letters(spark):
    k, wnd = 4, 10
    n, size, lo, hi = Counter(m for _, _, m in places(k)), Counter(), Counter(), Counter()
    for r, p, m in places(k):
        key = (r, (p - 1) // wnd)
        size[key] += 1
        lo[key] += n[m] <= 1
        hi[key] += n[m] >= 4
    want = {(t, r, x) for t, c in (("noise", lo), ("repeat", hi)) for (r, w), v in c.items() if 2 * v > size[r, w] for x in range(w * wnd, w * wnd + size[r, w])}
    assert {(r.track, r.rid, x) for r in kmer_windows(reads_of(spark), k, 1, 4, wnd).collect() for x in range(r.beg, r.end_)} == want
    last, seeds = {}, {}
    for r, p, m in places(k):
        if (r, m) in last:
            seeds.setdefault((r, (p - last[r, m]) >> 2), []).append(p)
        last[r, m] = p
    score = {b: sum(min(k, q - p) for p, q in zip(v, v[1:])) + k for b, v in seeds.items()}
    want = sorted((r, b, s, s + score.get((r, b + 1), 0), min(seeds[r, b]), max(seeds[r, b])) for (r, b), s in score.items() if s + score.get((r, b + 1), 0) >= 8)
    got = self_seed_hits(reads_of(spark), k, 2, 8)
    assert sorted((r.rid, r.band, r.score, r.total, r.amin, r.amax) for r in got.collect()) == want
