import random

import numpy as np

from readweave.operators.chains import PIECE, chain_many, chain_pair
from readweave.plans import REGISTRY

SF = "/root/testdata/sf0.001"


def test_many_pairs_as_one_by_one():
    """Pairs with equally many overlaps, chained at once, against the loop over one pair."""
    draw = random.Random(11)
    for m in (1, 2, 3, 5, 9):
        x = {c: np.zeros((200, m), "i8") for c in PIECE}
        for g in range(200):
            for i in range(m):
                a, n, shift = draw.randrange(0, 9000, 250), draw.choice((500, 750, 2500)), draw.choice((0, 0, 250, -250))
                row = (draw.randrange(10**6), draw.randrange(5) // 4, a, a + n, a + shift + 300, a + n + shift + 300, n - draw.choice((0, 100)))
                for c, v in zip(PIECE, row, strict=True):
                    x[c][g, i] = v
        chain, rank = chain_many(x)
        for g in range(200):
            want = {o: (c, r) for o, c, r in chain_pair({c: x[c][g] for c in PIECE})}
            assert {int(o): (int(c), int(r)) for o, c, r in zip(x["ovl_id"][g], chain[g], rank[g], strict=True)} == want


def test_overlaps_stay_with_their_read(spark):
    """What counts by A sends nothing after the overlaps are made."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, last, times in (("tile_coverage", "Generate", 0), ("chain_pieces", "MapInArrow", 0), ("separate_pairs_1", "MapInArrow", 1), ("coverage_mask", "Generate", 0)):
            plan = REGISTRY.queries[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
            assert plan[: plan.index(last)].count("Exchange") == times, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
