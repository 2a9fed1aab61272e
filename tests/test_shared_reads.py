"""Reads that two contigs share: against loops, and without a row sent for each pair of contigs."""

import random
from collections import Counter

from readweave.operators.evidence import contig_read_intersection, shared_ranges
from readweave.plans import REGISTRY

SF = "/root/testdata/sf0.001"


def test_pairs_against_loops(spark):
    draw = random.Random(3)
    rows = [(draw.randrange(12), draw.choice([None, *range(25)]), b := draw.randrange(500), b + 100) for _ in range(150)]
    at = {}
    for c, r, b, e in rows:
        x, y = at.get((c, r), (b, e))
        at[c, r] = min(x, b), max(y, e)
    size = Counter(c for c, _ in at)
    long = {c: 1000 + c % 3 for c in range(12)}
    cr = spark.createDataFrame(rows, "cid long, rid long, beg long, end_ long")
    pairs = [(c, d, r) for c, r in at for d in range(12) if c != d and r is not None and (d, r) in at]
    many = Counter((c, d) for c, d, _ in pairs)
    got = contig_read_intersection(cr, 20)
    assert sorted((x.c1, x.c2, x.shared, x.n1, x.n2) for x in got.collect()) == sorted((c, d, n, size[c], size[d]) for (c, d), n in many.items() if c < d and 100 * n > 20 * min(size[c], size[d]))
    got = shared_ranges(cr, spark.createDataFrame(sorted(long.items()), "cid long, len long"), 30)
    want = [(c, d, many[c, d], size[d], r, *at[c, r], *at[d, r]) for c, d, r in pairs if (-long[c], c) < (-long[d], d) and 100 * many[c, d] > 30 * size[d]]
    assert want and sorted(map(tuple, got.collect())) == sorted(want)


def test_pairs_of_contigs_are_not_sent(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("contig_read_intersection", "shared_blocks"):
            plan = REGISTRY.queries[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
            assert "arrays_zip" in plan and "Exchange" not in plan[: plan.index("arrays_zip")], name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
