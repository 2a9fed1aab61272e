"""Paths against a known genome, patches and chains by hand, the coverage stream against its batch form."""

import random

from pyspark.sql import functions as F

from readweave.operators import chains, graph, lift, patches, paths
from readweave.streaming import coverage

OVL = "ovl_id long, aread long, bread long, comp int, alen long, blen long, abpos long, aepos long, bbpos long, bepos long, diffs long"


def turn(s: str) -> str:
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def dovetails(spark, genome, size=100, step=60):
    """Reads of ``size`` every ``step`` bases, each third one reversed, and their exact end-to-end overlaps."""
    spots = [(i, p, i % 3 == 1) for i, p in enumerate(range(0, len(genome) - size + 1, step))]
    reads = [(i, turn(genome[p : p + size]) if r else genome[p : p + size], size) for i, p, r in spots]
    rows = []
    for i, p, r in spots:
        for j, q, t in spots:
            if i != j and abs(p - q) < size:
                g1, g2 = max(p, q), min(p, q) + size
                a = (p + size - g2, p + size - g1) if r else (g1 - p, g2 - p)
                # B's places on the overlap's strand, which is A's.
                b = (q + size - g2, q + size - g1) if r else (g1 - q, g2 - q)
                rows.append((len(rows), i, j, int(r != t), size, size, *a, *b, 0))
    return spark.createDataFrame(reads, "rid long, seq string, rlen long"), spark.createDataFrame(rows, OVL)


def test_contig_is_the_genome(spark):
    rng = random.Random(5)
    genome = "".join(rng.choice("ACGT") for _ in range(640))
    reads, o = dovetails(spark, genome)
    trim = reads.select("rid", F.lit(0).alias("tb"), F.col("rlen").alias("te"))
    edges = graph.build_edges(o, trim)
    found = paths.build_paths(edges, paths.best_next(edges, 1)).cache()
    assert sorted((r.rank, r.rid) for r in found.collect()) == [(i, i) for i in range(10)]
    (contig,) = paths.path_to_contigs(found, reads, trim, edges).collect()
    assert contig.seq in (genome, turn(genome))


def test_ring_is_cut_and_two_paths_stay_apart(spark):
    def both(a, b):
        return [(a, b, "r", 5, 0), (b, a, "l", 5, 0)]

    rows = both(1, 2) + both(2, 3) + both(3, 1) + both(10, 11)
    edges = spark.createDataFrame(rows, "src long, dst long, side string, ovh long, div long")
    got = {r.rid: (r.path, r.rank, r.comp) for r in paths.build_paths(edges, paths.best_next(edges, 1)).collect()}
    assert got == {1: (1, 0, 0), 2: (1, 1, 0), 3: (1, 2, 0), 10: (10, 0, 0), 11: (10, 1, 0)}
    joined = paths.join_path_ends(spark.createDataFrame([(1, 3, 1), (2, 11, 0)], "path long, rid long, rank long"), spark.createDataFrame([(3, 11)], "src long, dst long"))
    assert [tuple(r) for r in joined.collect()] == [(3, 11, 1, 2)]


def test_patched_read_and_shifted_interval(spark):
    reads = spark.createDataFrame([(1, "AAAAACCCCCGGGGG", "abcdefghijklmno", 15), (2, "TTTTTTTTAC", "0123456789", 10)], "rid long, seq string, qual string, rlen long")
    trim = spark.createDataFrame([(1, 1, 14)], "rid long, tb long, te long")
    cut = spark.createDataFrame([(1, 5, 10, 2, 1, 0, 3)], "aread long, beg long, end_ long, bread long, comp int, bb long, be long")
    (r,) = patches.apply_patches(reads, cut, trim, 1, ("seq", "qual")).collect()
    assert (r.seq, r.qual) == ("AAAA" + "GTA" + "GGGG", "bcde" + "987" + "klmn")
    iv = spark.createDataFrame([("t", 1, 0, 4), ("t", 1, 11, 15), ("t", 1, 5, 10)], "track string, rid long, beg long, end_ long")
    moved = patches.shift_intervals(iv, patches.kept_pieces(cut, reads, trim), 1)
    assert sorted((r.beg, r.end_) for r in moved.collect()) == [(0, 3), (8, 11)]


def test_chain_breaks_at_strand_and_wide_gap(spark):
    rows = [
        (1, 1, 2, 0, 90000, 90000, 0, 1000, 0, 1000, 0),
        (2, 1, 2, 0, 90000, 90000, 1500, 3500, 1500, 3500, 0),
        (3, 1, 2, 1, 90000, 90000, 4000, 5000, 4000, 5000, 0),
        (4, 1, 2, 0, 90000, 90000, 40000, 41000, 40000, 41000, 0),
    ]
    iv = spark.createDataFrame([], "track string, rid long, beg long, end_ long")
    got = {r.ovl_id: (r.chain, r.rank) for r in chains.chain_overlaps(spark.createDataFrame(rows, OVL), iv).collect()}
    assert got == {1: (0, 0), 2: (0, 1), 3: (1, 0), 4: (2, 0)}


def test_weak_tiles_outside_breaks(spark):
    pile = spark.createDataFrame([(1, t, 5, 0, 10 * t, 10 * t + 100, k) for t in range(4) for k in (1, 2)], "aread long, tile long, bread long, comp int, sb long, eb long, k int")
    tile_q = spark.createDataFrame([(1, 0, 0), (1, 1, 10), (1, 2, 30), (1, 3, 0)], "rid long, tile long, q long")
    breaks = spark.createDataFrame([(1, 300, 400)], "aread long, beg long, end_ long")
    assert sorted((r.tile, r.sb) for r in patches.weak_tiles(pile, tile_q, breaks).collect()) == [(0, 0), (2, 20)]


def test_names(spark):
    contigs = spark.createDataFrame([(7, "c1")], "cid long, name string")
    names = spark.createDataFrame([("c1",), ("c1_subseq_5:90",), ("none",)], "name string")
    got = {r.name: (r.cid, r.sub_beg, r.sub_end) for r in lift.resolve_names(names, contigs).collect()}
    assert got == {"c1": (7, None, None), "c1_subseq_5:90": (7, 5, 90), "none": (None, None, None)}


def test_stream_counts_repeated_rows_once(spark, tmp_path):
    rows = [(i, 1, 2 + i, 0, 1000, 1000, 100 * i, 100 * i + 500, 0, 500, 0, i % 2) for i in range(5)]
    o = spark.createDataFrame(rows, OVL + ", batch_id long")
    o.unionByName(o).repartition(3).write.parquet(f"{tmp_path}/in")
    source = lambda: spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    coverage.coverage_stream(source(), f"{tmp_path}/log", f"{tmp_path}/state", expected=1, snapshots=f"{tmp_path}/mask").awaitTermination()
    got = coverage.coverage_runs(coverage.read_log(spark, f"{tmp_path}/log"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, coverage.coverage_runs(coverage.coverage_deltas(o)).collect()))
    assert [tuple(r) for r in coverage.mask_from_coverage(got, 1).collect()] == [(1, 200, 700)]
    coverage.coverage_stream(source(), f"{tmp_path}/none", f"{tmp_path}/state2", frozen=True).awaitTermination()
    assert not (tmp_path / "none").exists()


def test_contained_read_is_saturated(spark):
    o = spark.createDataFrame([(1, 1, 2, 0, 300, 900, 0, 300, 5, 305, 0)], OVL)
    assert [tuple(r) for r in coverage.coverage_runs(coverage.coverage_deltas(o, 50, True)).collect()] == [(1, 0, 50, 255), (1, 50, 250, 255), (1, 250, 300, 255)]
