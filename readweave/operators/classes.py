"""Relations between contigs from chains, shared reads and tours, and the classes that follow from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Relations that make a contig an alternative of another one.
ALTERNATIVE = ("contained", "repeat", "reads", "bubble")


def all_relations(chained: DataFrame, shared: DataFrame, tours: DataFrame) -> DataFrame:
    """cid, other, kind: each relation once, and what it says of the partner.

    chained: rows of ``contig_relations`` (contained, repeat, bridge). shared: rows of ``read_alternatives`` (c2 is an alternative of c1). tours: contigs
    (cid, end1, end2) with the contigs whose paths their ends lie on, -1 for none: both on one is a bubble, one alone a spur. A
    contained, repeat, reads or bubble relation makes the partner one that ``has`` it (has_contained, ...); a bridge holds both ways.
    """
    c = F.col
    by_chain = chained.select(c("aread").alias("cid"), c("bread").alias("other"), c("relation").alias("kind"))
    by_read = shared.where("alternative").select(c("c2").alias("cid"), c("c1").alias("other"), F.lit("reads").alias("kind"))
    e1, e2 = c("end1"), c("end2")
    kind = F.when((e1 == e2) & (e1 != -1), "bubble").when((e1 == -1) != (e2 == -1), "spur")
    by_tour = tours.select("cid", F.greatest("end1", "end2").alias("other"), kind.alias("kind")).where("kind is not null and cid <> other")
    own = by_chain.unionByName(by_read).unionByName(by_tour)
    back = own.where(c("kind").isin("bridge", *ALTERNATIVE)).select(c("other").alias("cid"), c("cid").alias("other"), F.when(c("kind") == "bridge", "bridge").otherwise(F.concat(F.lit("has_"), "kind")).alias("kind"))
    return own.unionByName(back).distinct()


def contig_classes(contigs: DataFrame, relations: DataFrame, min_len: int = 100_000, min_reads: int = 5, max_repeat: int = 100, resolve_multi: bool = False) -> DataFrame:
    """cid, class, reason, alternatives, bridges, spurs: one row per contig (cid, len, reads, rep).

    Without an alternative relation a contig is PRIM if it is longer than ``min_len``, or has more than ``min_reads`` reads and less than
    ``max_repeat`` percent repeat bases; else DISCARD, and the reason names what fails (CREADS, LEN, REPEAT). With one it is
    ALT. With several it is DISCARD (MULTI); with ``resolve_multi`` ALT, if all of them are PRIM.
    """
    c = F.col
    alt = relations.where(c("kind").isin(*ALTERNATIVE)).select("cid", "other").distinct()
    n_alt = alt.groupBy("cid").agg(F.count(F.lit(1)).alias("alternatives"))
    rest = relations.where(c("kind").isin("bridge", "spur")).groupBy("cid").agg(F.count_distinct(F.when(c("kind") == "bridge", c("other"))).alias("bridges"), F.count_distinct(F.when(c("kind") == "spur", c("other"))).alias("spurs"))
    j = contigs.join(n_alt, "cid", "left").join(rest, "cid", "left").fillna(0, ["alternatives", "bridges", "spurs"])
    few, short, repetitive = c("reads") <= min_reads, c("len") <= min_len, 100 * c("rep") >= max_repeat * c("len")
    reason = F.concat_ws(",", F.when(few, "CREADS"), F.when(short, "LEN"), F.when(repetitive, "REPEAT"))
    good = ~short | (~few & ~repetitive)
    j = j.withColumn("class", F.when(c("alternatives") == 1, "ALT").when(c("alternatives") > 1, "DISCARD").when(good, "PRIM").otherwise("DISCARD"))
    j = j.withColumn("reason", F.when(c("alternatives") > 1, "MULTI").when(c("class") == "DISCARD", reason).otherwise(""))
    if resolve_multi:
        prim = alt.join(j.where("class = 'PRIM'").select(c("cid").alias("other"), F.lit(1).alias("_p")), "other", "left").groupBy("cid").agg((F.count(F.lit(1)) == F.count("_p")).alias("_all"))
        j = j.join(prim, "cid", "left")
        solved = (c("alternatives") > 1) & F.coalesce("_all", F.lit(False))
        j = j.withColumn("class", F.when(solved, "ALT").otherwise(c("class"))).withColumn("reason", F.when(solved, "").otherwise(c("reason")))
    return j.select("cid", "class", "reason", "alternatives", "bridges", "spurs")
