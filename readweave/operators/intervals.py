"""Interval tracks: union, join, gaps, clips and sweeps. Rows are (track, rid, beg, end_), half open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readweave.functions.columns import common

#: Width of the bins that turn an interval join into an equi-join.
BIN = 1000


def merge_intervals(iv: DataFrame, gap: int = 0, by: tuple[str, ...] = ("track", "rid")) -> DataFrame:
    """Union of overlapping or touching intervals (or such within ``gap``), by read."""
    w = Window.partitionBy(*by).orderBy("beg", "end_")
    before = F.max("end_").over(w.rowsBetween(Window.unboundedPreceding, -1))
    islands = iv.withColumn("_new", F.when(F.col("beg") <= before + gap, 0).otherwise(1)).withColumn("_g", F.sum("_new").over(w))
    return islands.groupBy(*by, "_g").agg(F.min("beg").alias("beg"), F.max("end_").alias("end_")).drop("_g")


def interval_join(left: DataFrame, right: DataFrame, key: str, lspan: tuple[str, str], rspan: tuple[str, str], min_bp: int = 1) -> DataFrame:
    """Pairs of the same key that share ``min_bp`` or more, with the shared length ``bp``.

    Both sides go into bins of BIN bases; a pair is taken in the first bin that both touch, so it comes once. There is no
    Cartesian product, and a long read's intervals meet only their neighbours.
    """

    def binned(df: DataFrame, b: str, e: str) -> DataFrame:
        first, last = F.floor(F.col(b) / BIN), F.floor((F.col(e) - 1) / BIN)
        return df.withColumn("_first", first).withColumn("_bin", F.explode(F.sequence(first, F.greatest(first, last))))

    a = binned(left, *lspan).withColumnRenamed("_first", "_lf")
    b = binned(right, *rspan).withColumnRenamed("_first", "_rf")
    pairs = a.join(b, [key, "_bin"]).where(F.col("_bin") == F.greatest("_lf", "_rf"))
    bp = common(F.col(lspan[0]), F.col(lspan[1]), F.col(rspan[0]), F.col(rspan[1]))
    return pairs.withColumn("bp", bp).where(F.col("bp") >= min_bp).drop("_bin", "_lf", "_rf")


def interval_gaps(iv: DataFrame) -> DataFrame:
    """Distance of each interval to the one before it on the read (null for the first)."""
    w = Window.partitionBy("track", "rid").orderBy("beg", "end_")
    return iv.withColumn("gap", F.col("beg") - F.lag("end_").over(w))


def clip_intervals(iv: DataFrame, reads: DataFrame, n: int = 1500) -> DataFrame:
    """Take ``n`` bases off both read ends; what becomes empty goes."""
    cut = iv.join(reads.select("rid", "rlen"), "rid").withColumn("beg", F.greatest("beg", F.lit(n))).withColumn("end_", F.least("end_", F.col("rlen") - n))
    return cut.where("beg < end_").select("track", "rid", "beg", "end_")


def interval_stats(iv: DataFrame, reads: DataFrame, bin_: int = 100) -> DataFrame:
    """Histogram of lengths with counts and bases from the longest bin on, and the share of all bases in percent of reads."""
    total = reads.agg(F.sum("rlen").alias("all_bases"))
    h = iv.withColumn("bin", F.floor((F.col("end_") - F.col("beg")) / bin_) * bin_).groupBy("track", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end_") - F.col("beg")).alias("bases"))
    w = Window.partitionBy("track").orderBy(F.desc("bin"))
    h = h.withColumn("cum_n", F.sum("n").over(w)).withColumn("cum_bases", F.sum("bases").over(w))
    return h.crossJoin(F.broadcast(total)).withColumn("pct", F.floor(100 * F.col("cum_bases") / F.col("all_bases"))).drop("all_bases")


def combine_tracks(iv: DataFrame, names: list[str], out: str) -> DataFrame:
    """Union of several tracks into one."""
    return merge_intervals(iv.where(F.col("track").isin(names)).withColumn("track", F.lit(out)))


def unique_intervals(iv: DataFrame, reads: DataFrame, trim: DataFrame, least: int = 10) -> DataFrame:
    """Parts of a trimmed read outside its intervals that are longer than ``least``."""
    span = reads.select("rid", "rlen").join(trim, "rid", "left").select("rid", F.coalesce("tb", F.lit(0)).alias("tb"), F.coalesce("te", F.lit(0)).alias("te")).where("tb < te")
    inner = merge_intervals(iv, by=("rid",)).join(span, "rid").withColumn("beg", F.greatest("beg", "tb")).withColumn("end_", F.least("end_", "te")).where("beg < end_")
    marks = inner.select("rid", "beg", "end_").unionByName(span.select("rid", F.col("te").alias("beg"), F.col("te").alias("end_")))
    w = Window.partitionBy("rid").orderBy("beg", "end_")
    marks = marks.join(span, "rid").withColumn("ubeg", F.coalesce(F.lag("end_").over(w), "tb"))
    return marks.where(F.col("beg") - F.col("ubeg") > least).select("rid", F.col("ubeg").alias("beg"), F.col("beg").alias("end_"))


def anchors(iv: DataFrame, reads: DataFrame, trim: DataFrame, dust: DataFrame, longest: int, window: int, least: int = 10) -> DataFrame:
    """``unique_intervals`` without those of up to ``longest`` bases that are low-complexity or stand beside it, and without low-complexity bases.

    A short interval goes if more than half of it is low-complexity; more than 15 % with a stretch over 100; a stretch over 20 in less than 100
    bases; or if in 100, 200, ... up to ``window`` bases before or behind it more than 20 % are low-complexity with a stretch over 30. Then
    repeats on both sides of it are one. An interval's part between low-complexity stretches stays, however short.
    """
    c = F.col
    low = merge_intervals(dust, by=("rid",)).select("rid", c("beg").alias("_b"), c("end_").alias("_e"))
    u = unique_intervals(iv, reads, trim, least)
    steps = sorted({*range(min(100, window), window + 1, 100), window})
    looks = [F.struct(F.lit(0).alias("at"), c("beg").alias("lb"), c("end_").alias("le"))]
    for n in steps:
        looks += [F.struct(F.lit(-n).alias("at"), F.greatest(c("beg") - n, F.lit(0)).alias("lb"), c("beg").alias("le")), F.struct(F.lit(n).alias("at"), c("end_").alias("lb"), F.least(c("end_") + n, "rlen").alias("le"))]
    short = u.where(c("end_") - c("beg") <= longest).join(reads.select("rid", "rlen"), "rid").select("rid", "beg", "end_", F.inline(F.array(*looks))).where("lb < le")
    met = interval_join(short, low, "rid", ("lb", "le"), ("_b", "_e")).groupBy("rid", "beg", "end_", "at").agg(F.sum("bp").alias("bp"), F.max("bp").alias("most"))
    size = c("end_") - c("beg")
    inside = (2 * c("bp") > size) | ((100 * c("bp") > 15 * size) & (c("most") > 100)) | ((size < 100) & (c("most") > 20))
    # Behind an interval whole percents count.
    beside = (c("most") > 30) & F.when(c("at") < 0, 100 * c("bp") > 20 * -c("at")).otherwise(F.floor(100 * c("bp") / c("at")) > 20)
    bad = met.where(F.when(c("at") == 0, inside).otherwise(beside)).select("rid", "beg", "end_").distinct()
    kept = u.join(bad, ["rid", "beg", "end_"], "left_anti")
    hits = interval_join(kept, low, "rid", ("beg", "end_"), ("_b", "_e")).select("rid", "beg", "end_", F.greatest("beg", "_b").alias("_b"), F.least("end_", "_e").alias("_e"))
    marks = hits.unionByName(kept.select("rid", "beg", "end_", c("end_").alias("_b"), c("end_").alias("_e")))
    w = Window.partitionBy("rid", "beg", "end_").orderBy("_b", "_e")
    out = marks.withColumn("_from", F.coalesce(F.lag("_e").over(w), c("beg")))
    return out.where("_from < _b").select("rid", c("_from").alias("beg"), c("_b").alias("end_"))


def unique_tip_trim(iv: DataFrame, reads: DataFrame, n: int = 500) -> DataFrame:
    """tb, te: from the first to the last stretch of ``n`` or more bases outside the intervals."""
    whole = reads.select("rid", F.lit(0).alias("tb"), F.col("rlen").alias("te"))
    u = unique_intervals(iv, reads, whole, n - 1)
    return u.groupBy("rid").agg(F.min("beg").alias("tb"), F.max("end_").alias("te"))


def spanning_reads(iv: DataFrame, trim: DataFrame, n: int = 300) -> DataFrame:
    """Intervals with max(n, 300) trimmed bases on both sides."""
    n = max(n, 300)
    return iv.join(trim, "rid").where((F.col("beg") - F.col("tb") >= n) & (F.col("te") - F.col("end_") >= n)).select("track", "rid", "beg", "end_")


def to_nested(iv: DataFrame) -> DataFrame:
    """One row per track and read, with its intervals in order."""
    return iv.groupBy("track", "rid").agg(F.array_sort(F.collect_list(F.struct("beg", "end_"))).alias("spans"))


def to_long(nested: DataFrame) -> DataFrame:
    return nested.select("track", "rid", F.inline("spans"))


def bed_rows(iv: DataFrame) -> DataFrame:
    """Text rows of a BED file."""
    return iv.select("track", "rid", F.concat_ws("\t", F.format_string("read_%d", "rid"), "beg", "end_", "track").alias("line"))


def sweep(events: DataFrame, hi: Column, lo: Column, by: str = "aread") -> DataFrame:
    """Regions in which a count of events stays up.

    ``events``: (by, pos, delta) rows. A region opens where the running sum exceeds ``hi`` and closes where it falls below
    ``lo``; in between the state stands. At one position, losses come before gains.
    """
    w = Window.partitionBy(by).orderBy("pos", "delta", "ovl_id")
    run = events.withColumn("_n", F.sum("delta").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    mark = F.when(F.col("_n") > hi, 1).when(F.col("_n") < lo, 0)
    state = F.coalesce(F.last(mark, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    run = run.withColumn("_s", state).withColumn("_p", F.coalesce(F.lag("_s").over(w), F.lit(0)))
    turns = run.where("_s <> _p").withColumn("_next", F.lead("pos").over(w))
    return turns.where("_s = 1 and _next is not null").select(F.col(by).alias("rid"), F.col("pos").alias("beg"), F.col("_next").alias("end_"))


def merge_blocks(*blocks: DataFrame) -> DataFrame:
    """Tracks of blocks in one table. A read that two blocks hold fails the query, as blocks are disjoint."""
    parts = [b.select("*", F.lit(i).alias("_block")) for i, b in enumerate(blocks)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    own = out.groupBy("track", "rid").agg(F.min("_block").alias("_x"), F.max("_block").alias("_y"))
    twice = F.raise_error(F.format_string("read %d of track %s is in two blocks", F.col("rid").cast("long"), F.col("track")))
    checked = out.join(own, ["track", "rid"]).where(F.when(F.col("_x") != F.col("_y"), twice.cast("boolean")).otherwise(True))
    return checked.select(*blocks[0].columns)


def track(iv: DataFrame, name: str) -> DataFrame:
    """Intervals of one track."""
    return iv.where(F.col("track") == name)


def has_track(iv: DataFrame, name: str, reads: DataFrame) -> DataFrame:
    """Reads (rid) that hold an interval of the track."""
    return reads.join(track(iv, name).select("rid").distinct(), "rid", "left_semi")


def track_values(iv: DataFrame, name: str, reads: DataFrame) -> DataFrame:
    """Each read's intervals of the track in order, as one array; empty without any."""
    spans = track(iv, name).groupBy("rid").agg(F.sort_array(F.collect_list(F.struct(F.col("beg").cast("long").alias("beg"), F.col("end_").cast("long").alias("end_")))).alias("spans"))
    return reads.select("rid").join(spans, "rid", "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<beg:bigint,end_:bigint>>")))
