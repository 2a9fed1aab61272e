"""Rules that SQL twins cover only in part: stitches that compete, broken blocks, runs across buckets, names in headers."""

import random

import pytest

from readweave.operators import graph as G
from readweave.operators import intervals as I
from readweave.operators import numbering as N
from readweave.operators import reads as R
from readweave.operators import stitching as S
from readweave.operators import summaries as U

COLS = "ovl_id long, aread long, bread long, comp int, alen int, blen int, abpos long, aepos long, bbpos long, bepos long, diffs long, flags int"


def stitched_by_hand(rows, fuzz, aggressive):
    """Row by row, as the rule is stated."""
    out = {r["ovl_id"]: dict(r) for r in rows}
    order = sorted(out.values(), key=lambda r: (r["aread"], r["bread"], r["comp"], r["abpos"], r["aepos"], r["bbpos"], r["bepos"], r["ovl_id"]))
    settled = 1 << 7 | 1 << 15 | 1 << 16 | 1 << 17
    begin = {r["ovl_id"]: (r["abpos"], r["bbpos"], r["aepos"]) for r in rows}
    for i, x in enumerate(order):
        while not x["flags"] & settled:
            best = None
            for y in order[i + 1 :]:
                if (y["aread"], y["bread"], y["comp"]) != (x["aread"], x["bread"], x["comp"]) or y["flags"] & settled:
                    continue
                da, db = abs(x["aepos"] - y["abpos"]), abs(x["bepos"] - y["bbpos"])
                if da < fuzz and db < fuzz and (aggressive or abs(da - db) < 40):
                    long = begin[y["ovl_id"]][2] - y["abpos"]
                    if best is None or long > best[0]:
                        best = (long, y)
            if best is None:
                break
            y = best[1]
            x["aepos"], x["bepos"], x["diffs"] = y["aepos"], y["bepos"], x["diffs"] + y["diffs"]
            x["flags"] &= ~(2 | 16)
            y["flags"] |= 2 | 128
    return sorted(tuple(r.values()) for r in out.values())


@pytest.mark.parametrize("fuzz,aggressive", [(40, False), (120, True), (100, False)])
def test_stitches_that_compete(spark, fuzz, aggressive):
    rng = random.Random(fuzz)
    rows = []
    for k in range(400):
        a, b, ab, n = rng.randrange(3), rng.randrange(3), rng.randrange(0, 1500, 10), rng.randrange(100, 400, 5)
        bb, m = ab + rng.randrange(0, 40), n + rng.randrange(-10, 10)
        flags = rng.choice([0, 0, 0, 2, 18, 32768])
        rows.append((k, a, b, rng.randrange(2), 3000, 3000, ab, ab + n, bb, bb + m, k % 9, flags))
    df = spark.createDataFrame(rows, COLS).repartition(3)
    got = sorted(tuple(r) for r in S.stitch(df, fuzz, aggressive).select(*[c.split()[0] for c in COLS.split(", ")]).collect())
    names = [c.split()[0] for c in COLS.split(", ")]
    want = stitched_by_hand([dict(zip(names, r, strict=True)) for r in rows], fuzz, aggressive)
    assert got == want
    assert sum(r[-1] & 128 > 0 for r in got) > 20


def test_stitch_of_nothing(spark):
    assert S.stitch(spark.createDataFrame([], COLS)).count() == 0


def test_a_read_in_two_blocks_fails(spark):
    a = spark.createDataFrame([("t", 1, 0, 5), ("t", 2, 0, 5)], "track string, rid long, beg long, end_ long")
    b = spark.createDataFrame([("t", 2, 7, 9)], a.schema)
    assert I.merge_blocks(a, b.where("rid = 3")).count() == 2
    with pytest.raises(Exception, match="in two blocks"):
        I.merge_blocks(a, b).collect()


def test_runs_and_ids_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(N, "BUCKET", 4)
    rng = random.Random(3)
    rows, wells = [], {}
    for f in ("a", "b"):
        well = 0
        for s in range(60):
            well = rng.choice([well, well, well, well + 1, None]) if well is not None else rng.randrange(3)
            if rng.random() < 0.9:
                rows.append((f, s * 2, well, rng.randrange(50)))
    df = spark.createDataFrame(rows, "file string, seq_id long, well long, rlen long").repartition(3)
    want, before = [], None
    for f, s, w, n in sorted(rows, key=lambda r: r[:2]):
        if before is None or before[0] != f or w is None or before[1] != w:
            want.append((f, s, w, n))
        elif n > want[-1][3]:
            want[-1] = (f, s, w, n)
        before = (f, w)
    key = lambda r: (r[0], r[1])
    assert sorted((tuple(r) for r in R.best_per_well(df).select("file", "seq_id", "well", "rlen").collect()), key=key) == sorted(want, key=key)
    got = sorted((r.file, r.seq_id, r.rid, r.boff) for r in N.assign_rids(df).collect())
    bases = 0
    for i, ((f, s, _, n), r) in enumerate(zip(sorted(rows, key=lambda r: r[:2]), got, strict=True)):
        assert r == (f, s, i, bases)
        bases += n


def test_short_assembly_takes_n50(spark):
    contigs = spark.createDataFrame([(1, 300), (2, 200)], "cid long, len long")
    r = U.assembly_summary(contigs, 10_000).first()
    assert (r.n50, r.ng50, r.longest_1, r.longest_2, r.longest_3, r.c0) == (300, 300, 300, 200, None, 2)
    r = U.assembly_summary(contigs, 800).first()
    assert (r.ng50, r.ng50_count) == (200, 2)


def test_turned_read_is_cut_at_its_turn(spark):
    """A read of 4000 bases whose second half is its first half turned: all but the shorter side goes, unless two overlaps span the turn."""
    row = (1, 7, 7, 1, 4000, 4000, 500, 3300, 700, 3500, 0, 0)
    o = spark.createDataFrame([row], COLS)
    trace = spark.createDataFrame([(1, i, 100) for i in range(28)], "ovl_id long, seg long, blen long")
    trim = spark.createDataFrame([(7, 0, 4000)], "rid long, tb long, te long")
    r = S.missed_adapters(o, trace, trim).first()
    assert (r.tb, r.te) in ((0, 1800), (0, 1900), (1900, 4000), (2000, 4000))
    spans = spark.createDataFrame([(2, 7, 8, 0, 4000, 4000, 900, 2900, 0, 2000, 0, 0), (3, 7, 9, 0, 4000, 4000, 900, 2900, 0, 2000, 0, 0)], COLS)
    assert S.missed_adapters(o.unionByName(spans), trace, trim).count() == 0


def test_edges_go_back_on_the_side_that_meets(spark):
    lens = {1: 3000, 2: 3000}
    trim = spark.createDataFrame([(r, 0, n) for r, n in lens.items()], "rid long, tb long, te long")
    for comp, back in ((0, "r"), (1, "l")):
        o = spark.createDataFrame([(1, 1, 2, comp, 3000, 3000, 0, 1000, 2000, 3000, 0, 0)], COLS)
        got = {(r.src, r.dst, r.side, r.ovh, r.kind) for r in G.strand_edges(o, trim).collect()}
        assert got == {(1, 2, "l", 2000, "fwd"), (2, 1, back, 2000, "rev")}
