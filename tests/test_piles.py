"""Segments are many times the overlaps: what is counted by A-read doesn't send them."""

import pytest

from readweave.operators import lift, overlaps, patches
from readweave.plans import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["tile_pile", "lift_intervals", "segment_quality", "quality_trim"])
def test_piles_are_not_sent(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = REGISTRY.queries[name](spark, SF)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Overlaps and their segments meet in a union; above it only reads are sent.
    at = next(i for i, line in enumerate(plan) if "Union" in line)
    sent = [line for line in plan[:at] if "Exchange" in line]
    assert all("hashpartitioning(rid#" in line for line in sent), sent


def test_segments_meet_their_overlap(spark):
    """A segment that is missing, an overlap without segments, and segments without an overlap."""
    o = spark.createDataFrame([(1, 7, 8, 0, 150, 420, 1000, 1270, 2000), (2, 7, 9, 1, 0, 200, 5, 205, 300), (3, 7, 9, 0, 0, 100, 0, 100, 300)], "ovl_id long, aread long, bread long, comp int, abpos long, aepos long, bbpos long, bepos long, blen long")
    t = spark.createDataFrame([(1, 7, 0, 1, 3, 50), (1, 7, 1, 2, 4, 90), (1, 7, 3, 4, 5, 20), (2, 7, 0, 0, 1, 100), (2, 7, 1, 1, 2, 100), (9, 7, 0, 0, 1, 100)], "ovl_id long, aread long, seg long, tile long, diffs long, blen long")
    keys = ["ovl_id", "tile", "sa", "ea", "sb", "eb"]
    old = sorted(map(tuple, lift.segments(o, t).select(keys).collect()))
    assert sorted(map(tuple, lift.piled_segments(o, t).select(keys).collect())) == old and len(old) == 5
    pile = sorted(map(tuple, patches.tile_pile(o, t).select("tile", "ovl_id", "k").collect()))
    assert pile == [(0, 2, 1), (1, 2, 1), (2, 1, 1)]
    iv = spark.createDataFrame([(7, 160, 290), (7, 160, 290), (7, 310, 390), (7, 50, 120)], "rid long, beg long, end_ long")
    lifted = sorted(map(tuple, lift.lift_intervals(o, t, iv).select("ovl_id", "rid", "beg", "end_", "abeg", "aend").collect()))
    # Tile 3 of overlap 1 is missing; overlap 2 is turned.
    assert lifted == [(1, 8, 1010, 1131, 160, 290)] * 2 + [(2, 9, 95, 135, 160, 200)] * 2 + [(2, 9, 175, 245, 50, 120)]
    q = sorted(map(tuple, overlaps.segment_quality(o, t, spark.createDataFrame([(7, 350), (8, 0), (5, 100)], "rid long, rlen long"), segmin=1).collect()))
    assert q == [(5, 0, 0), (7, 0, 1), (7, 1, 2), (7, 2, 0), (7, 3, 0)]


def test_weak_tiles_stay_by_their_read(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = REGISTRY.queries["weak_tiles"](spark, SF)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not any("Exchange" in line and ("tile#" in line or "_bin#" in line and "_a#" in line) for line in plan)


def test_letters_are_sent_once(spark):
    """To their A-read: votes, the choice and the read's assembly take place there."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = REGISTRY.queries["assemble_corrected"](spark, SF)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    at = next(i for i, line in enumerate(plan) if "SortMergeJoin [bread" in line)
    assert ["aread#" in line for line in plan[:at] if "Exchange" in line] == [True]


def test_letters_of_turned_reads(spark):
    """Reads with other letters than ASCII, and segments that go beyond the read."""
    reads = spark.createDataFrame([(2, "aacgt" * 4), (3, "é" + "ccgta" * 3)], "rid long, seq string")
    rows = [(1, 0, 1, 2, 0, 3, 8, 1), (1, 0, 2, 2, 0, 3, 8, 2), (1, 1, 1, 2, 1, 3, 8, 1), (1, 2, 1, 3, 0, 0, 4, 1), (1, 3, 1, 3, 1, 11, 16, 1), (1, 4, 1, 2, 1, 17, 30, 1)]
    pile = spark.createDataFrame(rows, "aread long, tile long, ovl_id long, bread long, comp int, sb long, eb long, k int")
    got = {r.tile: (r.seq, r.used) for r in patches.tile_consensus(pile, reads).collect()}
    assert got == {0: ("gtaac", 2), 1: ("ttacg", 1), 2: ("éccg", 1), 3: ("acggé", 1), 4: ("gtt", 1)}


def test_votes_by_columns_against_loops(spark, monkeypatch):
    """Lengths and letters that are equally frequent, letters beyond ASCII, and tiles that go over batches."""
    import random

    from readweave.operators import letters

    r = random.Random(4)
    rows = [(a, t, "".join(r.choice("acé" if a == 3 else "ac") for _ in range(r.choice([3, 4, 5]))), int(k == 0)) for a in (1, 2, 3) for t in range(20) for k in range(r.choice([1, 2, 3, 6, 9]))]

    def one(votes):
        size = min({len(p) for p, _ in votes}, key=lambda n: (-sum(len(p) == n for p, _ in votes), -max(o for p, o in votes if len(p) == n), n))
        of = [(p, o) for p, o in votes if len(p) == size]
        mine = next((p for p, o in of if o), None)
        pick = lambda i: min({p[i] for p, _ in of}, key=lambda x: (-sum(p[i] == x for p, _ in of), mine is None or mine[i] != x, x))
        return "".join(map(pick, range(size))), len(of)

    want = {(a, t): one([(p, o) for b, u, p, o in rows if (b, u) == (a, t)]) for a, t, _, _ in rows}
    import pyarrow as pa

    cut = lambda n: [pa.RecordBatch.from_pylist([dict(zip(("aread", "tile", "piece", "own"), x, strict=True)) for x in rows[i : i + n]]) for i in range(0, len(rows), n)]
    for most, n in ((1 << 16, 1000), (5, 3), (1, 1)):
        monkeypatch.setattr(letters, "VOTES", most)
        got = [x for b in letters.vote_columns(iter(cut(n))) for x in b.to_pylist()]
        assert {(x["aread"], x["tile"]): (x["seq"], x["used"]) for x in got} == want and len(got) == len(want)
