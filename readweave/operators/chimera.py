"""Chimeric reads by walls: many overlaps that stop too early in one place, many that start too late nearby, and no chain that leads across.

Walls are counted by tile, so all that a read's cuts are made of is bounded by its length, however many overlaps it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readweave.functions.lineage import settled

from .intervals import interval_join, merge_intervals
from .overlaps import with_ends

#: How far from read ends a stop is premature, how near to the trim it isn't, and the length above which a chimera must be repetitive.
PREMATURE, NEAR_TRIM, SHORT = 1000, 100, 1000
FAR = 2**31 - 1


def premature_ends(o: DataFrame, trim: DataFrame, twidth: int = 100) -> DataFrame:
    """aread, side (end, begin), tile, n: overlaps that stop or start inside both reads.

    Of the overlaps of a pair, in pile order, only the last can stop too early and only the first start too late. The pile's first and last
    overlap do not count, nor does a pair's only overlap that does both (a repeat).
    """
    order = ["comp", "abpos", "aepos", "bbpos", "bepos", "ovl_id"]
    pair = Window.partitionBy("aread", "bread").orderBy(*order)
    e = with_ends(o, trim).where("atb < ate")
    e = e.withColumn("_first", F.lag("ovl_id").over(pair).isNull()).withColumn("_last", F.lead("ovl_id").over(pair).isNull())
    ends = e.groupBy("aread").agg(F.min("bread").alias("_low"), F.max("bread").alias("_high"))
    c = F.col
    late = (c("bbpos") > PREMATURE) & (c("abpos") > c("atb") + PREMATURE) & (c("abpos") + NEAR_TRIM < c("ate"))
    early = (c("bepos") + PREMATURE < c("blen")) & (c("aepos") + PREMATURE < c("ate")) & (c("aepos") - NEAR_TRIM > c("atb"))
    border = (c("_first") & (c("bread") == c("_low"))) | (c("_last") & (c("bread") == c("_high")))
    lone = c("_first") & c("_last") & late & early
    side = F.when(border | lone, None).when(c("_last") & early, "end").when(c("_first") & late, "begin")
    tile = F.floor(F.when(side == "end", c("aepos")).otherwise(c("abpos")) / twidth)
    found = e.join(ends, "aread").select("aread", side.alias("side"), tile.alias("tile")).where("side is not null")
    return found.groupBy("aread", "side", "tile").agg(F.count(F.lit(1)).alias("n"))


def walls(ends: DataFrame, border: int = 7) -> DataFrame:
    """aread, side, at, wall: a look at tile ``at`` finds a wall there, or in the next tile if both together have ``border`` stops."""
    near = ends.select("aread", "side", "n", "tile", F.explode(F.array(F.col("tile"), F.col("tile") - 1)).alias("at")).where("at >= 0")
    here, beyond = (F.sum(F.when(F.col("tile") == F.col("at") + k, F.col("n")).otherwise(0)).alias(name) for k, name in ((0, "_here"), (1, "_next")))
    found = near.groupBy("aread", "side", "at").agg(here, beyond).where(F.col("_here") + F.col("_next") >= border)
    return found.select("aread", "side", "at", F.when(F.col("_here") >= border, F.col("at")).otherwise(F.col("at") + 1).alias("wall"))


def longest_chains(chains: DataFrame, trim: DataFrame, fuzz: int, anchor: int, min_len: int) -> DataFrame:
    """aread, low, high, need_low, need_high: a place between low and high is crossed by the pair's longest chain, if the kept part starts at need_low or later and ends at need_high or earlier.

    A chain that starts or ends with its B-read needs nothing on that side. A pair's only overlap needs nothing at all.
    """
    s = with_ends(chains, trim).groupBy("aread", "bread", "chain").agg(
        F.count(F.lit(1)).alias("n"), F.min("abpos").alias("ab"), F.max("aepos").alias("ae"), F.min("bbpos").alias("bb"), F.max("bepos").alias("be"),
        F.sum(F.col("aepos") - F.col("abpos")).alias("len"), F.first("btb").alias("btb"), F.first("bte").alias("bte"),
    )
    best = s.groupBy("aread", "bread").agg(F.sum("n").alias("all"), F.max_by(F.struct("ab", "ae", "bb", "be", "len", "btb", "bte"), F.struct("len", -F.col("chain"))).alias("c")).select("aread", "all", "c.*")
    alone = F.col("all") == 1
    one = F.when(alone, 1).otherwise(0)  # strictly inside for a single overlap
    low, high = F.col("ab") + anchor + one, F.col("ae") - anchor - one
    need_low = F.when(alone | (F.col("bb") - fuzz <= F.col("btb")), 0).otherwise(F.greatest(F.col("ab") - fuzz, F.lit(0)))
    need_high = F.when(alone | (F.col("be") + fuzz >= F.col("bte")), FAR).otherwise(F.col("ae") + fuzz)
    return best.where(F.col("len") >= min_len + one).select("aread", low.alias("low"), high.alias("high"), need_low.alias("need_low"), need_high.alias("need_high")).where("low <= high")


def cut(twidth: int, most: int, s: Column, e: Column, b: Column) -> Column:
    """One look at a begin wall ``b`` from end wall ``e``: a new state."""
    low, high = F.least(e["wall"], b["wall"]) * twidth, F.greatest(e["wall"], b["wall"]) * twidth
    pair = F.try_element_at(F.col("pairs"), low * (1 << 31) + high)
    seen = ~s["done"] & (b["at"] >= s["next"]) & (b["at"] <= F.floor(s["te"] / twidth))
    crossed = F.exists(pair["spans"], lambda c: (c["need_low"] <= s["tb"]) & (c["need_high"] >= s["te"]))
    right = low - s["tb"] > s["te"] - high
    does = (s["n"] == 0) | (low < s["te"])

    def state(tb: Column, te: Column, n: Column, after: Column, done: Column) -> Column:
        return F.struct(tb.cast("long").alias("tb"), te.cast("long").alias("te"), n.cast("long").alias("n"), after.cast("long").alias("next"), done.alias("done"))

    kept = state(F.when(does & ~right, high).otherwise(s["tb"]), F.when(does & right, low).otherwise(s["te"]), s["n"] + 1, s["next"], F.lit(True))
    same = lambda after: state(s["tb"], s["te"], s["n"], after, s["done"])
    return F.when(~seen, s).when((high - low > most) | pair["rejected"], same(b["wall"] + 1)).when(crossed, same(b["wall"] + 3)).otherwise(kept)


def chimera_walls(o: DataFrame, trim: DataFrame, repeats: DataFrame, chains: DataFrame, twidth: int = 100, border: int = 7, most: int = 8000, repeat_pct: int = 70, fuzz: int = 0, anchor: int = 800, min_chain: int = 3000, drop: bool = False) -> DataFrame:
    """rid, tb, te, chimeras: the part that stays of each read with a chimera; with ``drop`` nothing of it stays (0, 0).

    End walls are looked at from left to right, each against the begin walls from left to right: a pair up to ``most`` apart, repetitive
    (``repeat_pct``) if longer than SHORT, and crossed by no chain (``longest_chains``, of ``chain_overlaps``) is a chimera: the longer side of
    what is left stays. Looks skip the two tiles after an end wall, and after a begin wall that is crossed; one that is too far or not
    repetitive skips nothing. A chain that needs the read's end to be whole is held against what earlier cuts left.
    """
    found = settled(walls(premature_ends(o, trim, twidth), border))
    ends, begins = (found.where(F.col("side") == s).drop("side") for s in ("end", "begin"))
    low, high = F.least("wall", "_w") * twidth, F.greatest("wall", "_w") * twidth
    spans = ends.select("aread", "wall").distinct().join(begins.select("aread", F.col("wall").alias("_w")).distinct(), "aread").select("aread", low.alias("beg"), high.alias("end_")).distinct().where(F.col("end_") - F.col("beg") <= most)
    spans = settled(spans)
    rep = merge_intervals(repeats, by=("rid",)).select(F.col("rid").alias("aread"), F.col("beg").alias("_b"), F.col("end_").alias("_e"))
    bases = interval_join(spans.where("end_ > beg"), rep, "aread", ("beg", "end_"), ("_b", "_e")).groupBy("aread", "beg", "end_").agg(F.sum("bp").alias("rep"))
    lines = longest_chains(chains, trim, fuzz, anchor, min_chain).withColumn("_stop", F.col("high") + 1)
    met = interval_join(spans.withColumn("_end", F.col("end_") + 1), lines, "aread", ("beg", "_end"), ("low", "_stop")).where("low <= beg and high >= end_")
    # No more rows for an interval than a read has places.
    met = met.groupBy("aread", "beg", "end_", "need_low").agg(F.max("need_high").alias("need_high"))
    met = met.groupBy("aread", "beg", "end_").agg(F.collect_list(F.struct(F.col("need_low").cast("long").alias("need_low"), F.col("need_high").cast("long").alias("need_high"))).alias("spans"))
    size = F.col("end_") - F.col("beg")
    rejected = (size > SHORT) & (100 * F.coalesce("rep", F.lit(0)) < repeat_pct * size)
    key = (F.col("beg").cast("long") * (1 << 31) + F.col("end_")).alias("key")
    none = F.array().cast("array<struct<need_low: bigint, need_high: bigint>>")
    pairs = spans.join(bases, ["aread", "beg", "end_"], "left").join(met, ["aread", "beg", "end_"], "left")
    pairs = pairs.groupBy("aread").agg(F.map_from_entries(F.collect_list(F.struct(key, F.struct(rejected.alias("rejected"), F.coalesce("spans", none).alias("spans"))))).alias("pairs"))
    lists = [w.groupBy("aread").agg(F.array_sort(F.collect_list(F.struct("at", "wall"))).alias(n)) for w, n in ((ends, "ends"), (begins, "begins"))]
    reads = pairs.join(lists[0], "aread").join(lists[1], "aread").join(trim.select(F.col("rid").alias("aread"), "tb", "te"), "aread")
    start = F.struct(F.col("tb").cast("long").alias("tb"), F.col("te").cast("long").alias("te"), F.lit(0).cast("long").alias("n"), F.floor(F.col("tb") / twidth).cast("long").alias("next"), F.lit(False).alias("done"))

    def again(s: Column, after: Column) -> Column:
        return F.struct(s["tb"], s["te"], s["n"], after.cast("long").alias("next"), F.lit(False).alias("done"))

    def look(s: Column, e: Column) -> Column:
        inner = F.aggregate("begins", again(s, F.floor(s["tb"] / twidth)), lambda t, b: cut(twidth, most, t, e, b), lambda t: again(t, e["wall"] + 3))
        return F.when((e["at"] >= s["next"]) & (e["at"] <= F.floor(s["te"] / twidth)), inner).otherwise(s)

    out = reads.select("aread", "tb", "te", F.aggregate("ends", start, look).alias("s")).where("s.n > 0")
    kept = F.greatest("s.tb", "tb"), F.least("s.te", "te")
    return out.select(F.col("aread").alias("rid"), *((F.lit(0) if drop else k).cast("long").alias(n) for k, n in zip(kept, ("tb", "te"), strict=True)), F.col("s.n").alias("chimeras"))

