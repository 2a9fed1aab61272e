"""Rescue of overlaps that repeat rules discarded, for piles with live exits on one side only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readweave.functions.columns import bit, forward_b, has, set_flag
from readweave.functions.lineage import settled

from .intervals import interval_join, merge_intervals
from .overlaps import flagged

#: Bases on both sides that anchor an overlap, width of a bin, bases at trimmed ends without junctions, bins of a run, bases around a junction, bin of leftovers.
ANCHOR, BIN, TIPS, RUN, NEAR, LEFTOVER = 500, 100, 1000, 7, 100, 1000
#: Overlaps with one of these are never rescued; those that may gain OPTIONAL have no flags but the last three.
EXCLUDED, ALLOWED = ("LOCAL", "TRIM", "CONT", "STITCH", "GAP", "DIFF"), ("DISCARD", "REPEAT", "COMP")


def mask(*names: str) -> int:
    return reduce(lambda a, n: a | bit(n), names, 0)


def clear(flags: Column, name: str) -> Column:
    return flags.bitwiseAND(F.lit(~bit(name)))


def open_side(o: DataFrame, trim: DataFrame) -> DataFrame:
    """aread, tb, te, open (l, r): piles with live exits on the other side alone. An overlap of the whole trimmed read, live or not, closes both."""
    t = flagged(o).join(trim.where("tb < te").select(F.col("rid").alias("aread"), "tb", "te"), "aread")
    live, left, right = ~has(F.col("flags"), "DISCARD"), F.col("abpos") == F.col("tb"), F.col("aepos") == F.col("te")
    s = t.groupBy("aread", "tb", "te").agg(F.count_if(live & left).alias("l"), F.count_if(live & right).alias("r"), F.count_if(left & right).alias("w"))
    return s.where("w = 0 and (l > 0) <> (r > 0)").select("aread", "tb", "te", F.when(F.col("l") == 0, "l").otherwise("r").alias("open"))


def joined_repeats(iv: DataFrame, piles: DataFrame, merge: int) -> DataFrame:
    """aread, beg, end_: repeats cut to the trim, neighbours closer than ``merge`` as one; with ``merge`` of 100 or more, an interval of up to 100 bases joins no other."""
    m = merge_intervals(iv, by=("rid",)).withColumnRenamed("rid", "aread").join(piles, "aread")
    m = m.select("aread", F.greatest("beg", "tb").alias("beg"), F.least("end_", "te").alias("end_")).where("beg < end_")
    w = Window.partitionBy("aread").orderBy("beg", "end_")
    near = F.col("beg") - F.lag("end_").over(w) < merge
    on = near & (F.lit(merge < 100) | (F.col("end_") - F.col("beg") > 100))
    isl = m.withColumn("_new", F.when(on, 0).otherwise(1)).withColumn("_g", F.sum("_new").over(w))
    return isl.groupBy("aread", "_g").agg(F.min("beg").alias("beg"), F.max("end_").alias("end_")).drop("_g")


def junctions(o: DataFrame, piles: DataFrame, repeats: DataFrame, cov: int, aggressive: bool = False) -> DataFrame:
    """aread, beg, end_: NEAR bases in the middle of each run of more than RUN bins of a repeat with anchored coverage in (0, ``cov``).

    A run counts if a bin of the same repeat ends it. Repeats that a live overlap spans by ANCHOR bases have none. A LOCAL overlap counts ``cov`` times
    unless ``aggressive``.
    """
    c = F.col
    use = flagged(o).join(piles, "aread").withColumn("_b", c("abpos") + ANCHOR).withColumn("_e", c("aepos") - ANCHOR)
    live = use.where(~has(c("flags"), "DISCARD")).where("_b < _e").select("aread", "_b", "_e")
    spanned = interval_join(repeats, live, "aread", ("beg", "end_"), ("_b", "_e")).where("_b <= beg and _e >= end_").select("aread", "beg", "end_").distinct()
    r = repeats.join(spanned, ["aread", "beg", "end_"], "left_anti").join(piles, "aread")
    first, stop = F.floor(F.greatest(c("tb") + TIPS, c("beg") + ANCHOR) / BIN), F.floor(F.least(c("te") - TIPS, c("end_") - ANCHOR) / BIN)
    r = r.withColumn("_first", first).withColumn("_stop", stop).where("_first < _stop").select("aread", "beg", "_stop", F.explode(F.sequence(c("_first"), c("_stop") - 1)).alias("bin"))
    plain = use.where(c("flags").bitwiseAND(F.lit(mask("STITCH", "TRIM"))) == 0)
    once = F.lit(1) if aggressive else F.when(has(c("flags"), "LOCAL"), cov).otherwise(1)
    low, high = F.floor(c("_b") / BIN), F.floor(c("_e") / BIN)
    bins = plain.select("aread", once.alias("n"), low.alias("_lo"), high.alias("_hi")).where("_lo < _hi").select("aread", "n", F.explode(F.sequence(c("_lo"), c("_hi") - 1)).alias("bin")).groupBy("aread", "bin").agg(F.sum("n").alias("n"))
    some = r.join(bins, ["aread", "bin"]).where(c("n") < cov)
    w = Window.partitionBy("aread", "beg").orderBy("bin")
    runs = some.withColumn("_g", c("bin") - F.row_number().over(w)).groupBy("aread", "beg", "_stop", "_g").agg(F.min("bin").alias("_f"), (F.max("bin") + 1).alias("_l"))
    middle = F.floor((c("_f") + c("_l")) / 2) * BIN - BIN // 2
    return runs.where((c("_l") - c("_f") > RUN) & (c("_l") < c("_stop"))).select("aread", middle.alias("beg"), (middle + BIN).alias("end_"))


def at_junctions(o: DataFrame, piles: DataFrame, spots: DataFrame, cov: int) -> DataFrame:
    """ovl_id of REPEAT overlaps with an overhang that span, by ANCHOR bases, a junction crossed by cov / 2 to cov overlaps that are live or could be rescued."""
    c = F.col
    use = flagged(o).join(piles, "aread").where(c("aepos") - c("abpos") > 2 * NEAR)
    whole = c("flags").bitwiseAND(F.lit(mask(*EXCLUDED))) == 0
    could = has(c("flags"), "REPEAT") & whole
    use = use.where(~has(c("flags"), "DISCARD") | could).select("ovl_id", "aread", "abpos", "aepos", could.alias("_could"), ((c("abpos") <= c("tb")) | (c("aepos") >= c("te"))).alias("_over"))
    met = interval_join(spots, use, "aread", ("beg", "end_"), ("abpos", "aepos")).where((c("abpos") + NEAR < c("beg")) & (c("aepos") - NEAR > c("end_")))
    n = met.groupBy("aread", "beg", "end_").agg(F.count(F.lit(1)).alias("n")).where((c("n") <= cov) & (c("n") >= cov // 2))
    return met.join(n, ["aread", "beg", "end_"], "left_semi").where("_could and _over").where((c("abpos") + ANCHOR < c("beg")) & (c("aepos") - ANCHOR > c("end_"))).select("aread", "ovl_id").distinct()


def into_unique(o: DataFrame, piles: DataFrame, iv: DataFrame, trim: DataFrame, cov: int, min_unique: int) -> DataFrame:
    """ovl_id of overlaps at the open side whose B goes on into unique sequence: what is left of B's repeat there falls in a bin of LEFTOVER bases with 3 to cov - 1 members."""
    c = F.col
    use = at_open_side(o, piles)
    rep = merge_intervals(iv, by=("rid",)).join(trim.where("tb < te").select("rid", "tb", "te"), "rid").select("rid", F.greatest("beg", "tb").alias("beg"), F.least("end_", "te").alias("end_")).where("beg < end_")
    unique = trim.where("tb < te").select("rid", (c("te") - c("tb")).alias("_t")).join(rep.groupBy("rid").agg(F.sum(c("end_") - c("beg")).alias("_r")), "rid", "left").select("rid", (c("_t") - F.coalesce("_r", F.lit(0))).alias("_u"))
    bb, be = forward_b(c("comp"), c("blen"), c("bbpos"), c("bepos"))
    goes_left = (c("open") == "l") != (c("comp") == 1)
    points = use.select("ovl_id", "aread", c("bread").alias("rid"), "flags", goes_left.alias("_left"), F.when(goes_left, bb).otherwise(be).alias("_p")).withColumn("_q", c("_p") + 1)
    met = interval_join(points, rep, "rid", ("_p", "_q"), ("beg", "end_")).where("beg < _p").join(unique, "rid").where(c("_u") >= min_unique)
    free = c("flags").bitwiseAND(F.lit(~mask(*ALLOWED))) == 0
    left = F.floor(F.when(c("_left"), c("_p") - c("beg")).otherwise(c("end_") - c("_p")) / LEFTOVER)
    binned = met.where(free).select("aread", "ovl_id", left.alias("bin"))
    many = binned.groupBy("aread", "bin").agg(F.count(F.lit(1)).alias("n")).where((c("n") > 2) & (c("n") < cov))
    return binned.join(many, ["aread", "bin"], "left_semi").select("aread", "ovl_id")


def at_open_side(o: DataFrame, piles: DataFrame) -> DataFrame:
    exits = F.when(F.col("open") == "l", F.col("abpos") == F.col("tb")).otherwise(F.col("aepos") == F.col("te"))
    return flagged(o).join(piles, "aread").where((F.col("flags").bitwiseAND(F.lit(mask(*EXCLUDED))) == 0) & exits)


def longest_exits(o: DataFrame, piles: DataFrame, cov: int) -> DataFrame:
    """ovl_id of the longest overlap of each B at the open side, where fewer than cov - 1 B-reads are there."""
    w = Window.partitionBy("aread", "bread").orderBy(F.desc(F.col("aepos") - F.col("abpos")), "comp", "abpos", "aepos", "bbpos", "bepos", "ovl_id")
    best = at_open_side(o, piles).withColumn("_r", F.row_number().over(w)).where("_r = 1")
    few = best.groupBy("aread").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") + 1 < cov).select("aread")
    return best.join(few, "aread", "left_semi").select("aread", "ovl_id")


def rescue_modules(o: DataFrame, iv: DataFrame, trim: DataFrame, cov: int, mode: int = 2, merge: int = 0, min_unique: int = -1, aggressive: bool = False) -> DataFrame:
    """Overlaps with new flags. Piles with live exits on one side only and a repeat are tried in up to ``mode`` ways, each where the one before gave nothing:

    1, overlaps that span a junction inside a repeat become MODULE; 2, overlaps that lead into unique sequence of B become OPTIONAL;
    3, the longest overlap of each B at the open side becomes OPTIONAL. Rescued overlaps lose DISCARD.
    """
    o = flagged(o)
    piles = settled(open_side(o, trim))
    repeats = settled(joined_repeats(iv, piles, max(merge, min_unique)))
    piles = settled(piles.join(repeats.select("aread").distinct(), "aread", "left_semi"))
    found = settled(at_junctions(o, piles, settled(junctions(o, piles, repeats, cov, aggressive)), cov).withColumn("_by", F.lit("MODULE")))
    for step, more in ((2, lambda p: into_unique(o, p, iv, trim, cov, min_unique)), (3, lambda p: longest_exits(o, p, cov))):
        if mode >= step:
            left = piles.join(found.select("aread").distinct(), "aread", "left_anti")
            found = settled(found.unionByName(more(left).withColumn("_by", F.lit("OPTIONAL"))))
    out = o.join(found.select("ovl_id", "_by"), "ovl_id", "left")
    kept = F.when(F.col("_by").isNotNull(), clear(F.col("flags"), "DISCARD")).otherwise(F.col("flags"))
    for name in ("MODULE", "OPTIONAL"):
        kept = set_flag(kept, name, F.coalesce(F.col("_by") == name, F.lit(False)))
    return out.withColumn("flags", kept).drop("_by")
