import random

from readweave.operators.reads import band_scores, scaled_cap, seed_pairs


def test_turned_overlap_keeps_one_diagonal(spark):
    """A read and the turned copy of its end: all seeds have comp 1 and lie on one diagonal, which makes a band."""
    draw = random.Random(5)
    a = "".join(draw.choice("acgt") for _ in range(400))
    b = a[150:][::-1].translate(str.maketrans("acgt", "tgca"))
    reads = spark.createDataFrame([(1, a), (2, b)], "rid long, seq string")
    seeds = seed_pairs(reads, 14, scaled_cap(reads, 14, 8), both_strands=True)
    assert {(r.comp, r.apos - r.bpos) for r in seeds.collect()} == {(1, 150)} and seeds.count() == 250 - 13
    assert [(r.comp, r.score, r.amin, r.amax) for r in band_scores(seeds, 14).collect()] == [(1, 250, 151, 387)]
