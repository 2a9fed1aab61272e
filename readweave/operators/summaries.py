"""One-row summaries and tables of lengths: reads, overlaps, assemblies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .overlaps import contained_reads, flagged, purge
from .reads import n50


def read_summary(lens: DataFrame) -> DataFrame:
    """One row: reads, bases, whole mean and whole deviation (of the population, around the whole mean). Column: rlen."""
    square = F.col("rlen").cast("decimal(18,0)") * F.col("rlen").cast("decimal(18,0)")
    s = lens.agg(F.count(F.lit(1)).alias("n"), F.sum("rlen").cast("long").alias("bases"), F.sum(square).cast("decimal(38,0)").alias("_q"))
    s = s.withColumn("mean", F.floor(F.col("bases") / F.col("n")))
    off = F.col("_q") - 2 * F.col("mean") * F.col("bases") + F.col("n") * F.col("mean") * F.col("mean")
    return s.withColumn("deviation", F.floor(F.sqrt(off.cast("double") / F.col("n")))).drop("_q")


def length_table(lens: DataFrame, bin_: int = 1000, gsize: int | None = None) -> DataFrame:
    """For each bin that holds reads, of all reads as long or longer: percent of reads, of bases, mean length, coverage of a genome of ``gsize``."""
    h = lens.withColumn("bin", F.floor(F.col("rlen") / bin_) * bin_).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("rlen").alias("bases"))
    w = Window.orderBy(F.desc("bin"))  # one row for each bin
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cn, cb = F.sum("n").over(w), F.sum("bases").over(w)
    share = lambda c, of: F.lit(100.0) * c / F.sum(of).over(whole)
    cols = [share(cn, "n").alias("pct_reads"), share(cb, "bases").alias("pct_bases"), F.floor(cb / cn).alias("average")]
    return h.select("bin", "n", *cols, *([(cb / F.lit(float(gsize))).alias("coverage")] if gsize else []))


def overlap_summary(o: DataFrame, trim: DataFrame, fuzz: int = 0) -> DataFrame:
    """One row of the live overlaps: their number, complement and identity ones, distinct A-reads, B-reads and reads, contained reads."""
    live = purge(flagged(o))
    n = live.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("comp") == 1).alias("n_comp"), F.count_if(F.col("aread") == F.col("bread")).alias("n_identity")
    )
    end = lambda c, a: F.struct(F.col(c).alias("rid"), F.lit(a).alias("a"), F.lit(1 - a).alias("b"))
    ends = F.inline(F.array(end("aread", 1), end("bread", 0)))
    seen = live.select(ends).groupBy("rid").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    reads = seen.agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b"), F.count(F.lit(1)).alias("n_any"))
    held = contained_reads(live, trim, fuzz).agg(F.count(F.lit(1)).alias("n_contained"))
    return n.crossJoin(F.broadcast(reads)).crossJoin(F.broadcast(held))  # one row each


def ng_table(contigs: DataFrame, gsize: int, step: int = 10) -> DataFrame:
    """For each tenth of the genome: the length at which the longest contigs first hold it, and their number; no row beyond the assembly."""
    return n50(contigs, tuple(range(step, 101, step)), gsize)


def assembly_summary(contigs: DataFrame, gsize: int, classes: tuple[int, ...] = (200_000, 1_000_000, 5_000_000, 10_000_000, 20_000_000)) -> DataFrame:
    """One row: contigs, bases, N50 and NG50 with their counts, the longest three (null if fewer), contigs by class of length (c0 is the shortest).

    NG50 is N50 where the assembly is shorter than half the genome.
    """
    number = F.lit(0)
    for bound in classes:
        number = number + (F.col("len") >= bound).cast("int")
    by = contigs.groupBy("len").agg(F.count(F.lit(1)).alias("c")).withColumn("_k", number)
    kinds = [F.coalesce(F.sum(F.when(F.col("_k") == k, F.col("c"))), F.lit(0)).alias(f"c{k}") for k in range(len(classes) + 1)]
    s = by.agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("len")).alias("bases"), *kinds)
    top = contigs.select("len").orderBy(F.desc("len")).limit(3).agg(F.sort_array(F.collect_list("len"), False).alias("_t"))
    top = top.select(*(F.get("_t", F.lit(i)).alias(f"longest_{i + 1}") for i in range(3)))
    own = n50(contigs, (50,)).select(F.col("n_len").alias("n50"), F.col("n_count").alias("n50_count"))
    given = n50(contigs, (50,), gsize).select(F.col("n_len").alias("_g"), F.col("n_count").alias("_gc"))
    j = s.crossJoin(F.broadcast(top)).join(F.broadcast(own), how="left", on=F.lit(True)).join(F.broadcast(given), how="left", on=F.lit(True))
    return j.withColumn("ng50", F.coalesce("_g", "n50")).withColumn("ng50_count", F.coalesce("_gc", "n50_count")).drop("_g", "_gc")
