"""Coordinates carried from one read to another: through trace segments, through edits, through names.

Trace rows are (ovl_id, aread, seg, tile, diffs, blen): the segment of tile t lies on [100 t, 100 (t + 1)) of A, cut to the overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readweave.functions.columns import forward_b, set_flag

from .intervals import interval_join, merge_intervals
from .overlaps import beside, flagged, with_ends


def segments(o: DataFrame, trace: DataFrame, twidth: int = 100) -> DataFrame:
    """Trace rows with the stretches they cover: [sa, ea) of A and [sb, eb) of B, on the overlap's strand."""
    before = Window.partitionBy("ovl_id").orderBy("tile").rowsBetween(Window.unboundedPreceding, 0)
    t = trace.select("ovl_id", "tile", F.col("diffs").alias("sdiffs"), F.col("blen").alias("sl")).withColumn("_to", F.sum("sl").over(before))
    j = t.join(o.select("ovl_id", "abpos", "aepos", "bbpos"), "ovl_id")
    sa, ea = F.greatest("abpos", F.col("tile") * twidth), F.least("aepos", (F.col("tile") + 1) * twidth)
    return j.select("ovl_id", "tile", "sdiffs", "sl", sa.alias("sa"), ea.alias("ea"), (F.col("bbpos") + F.col("_to") - F.col("sl")).alias("sb"), (F.col("bbpos") + F.col("_to")).alias("eb"))


def on_b(pos: Column) -> Column:
    """An A position within a segment, carried to B in proportion, rounded down."""
    return F.col("sb") + F.floor((pos - F.col("sa")) * F.col("sl") / (F.col("ea") - F.col("sa")))


def piled_segments(o: DataFrame, trace: DataFrame, twidth: int = 100, carry: tuple[str, ...] = ()) -> DataFrame:
    """``segments`` with aread and columns of their overlap to ``carry``, for what meets by A-read: where both tables lie by it, no segment is sent."""
    j = beside(trace.select("aread", "ovl_id", "tile", F.col("diffs").alias("sdiffs"), F.col("blen").alias("sl")), o, ["abpos", "aepos", "bbpos", *carry], {"_to": "sl"})
    sa, ea = F.greatest("abpos", F.col("tile") * twidth), F.least("aepos", (F.col("tile") + 1) * twidth)
    return j.select("aread", "ovl_id", "tile", "sdiffs", "sl", sa.alias("sa"), ea.alias("ea"), (F.col("bbpos") + F.col("_to") - F.col("sl")).alias("sb"), (F.col("bbpos") + F.col("_to")).alias("eb"), *carry)


def lift_intervals(o: DataFrame, trace: DataFrame, iv: DataFrame, twidth: int = 100, least: int = 1) -> DataFrame:
    """The part of each A interval inside an overlap (``least`` bases or more), on B's forward strand: (ovl_id, aread, rid, beg, end_, abeg, aend).

    A read's intervals meet its overlaps as one array, and both ends of each part follow the segment that they lie in, in the overlap's order: where
    overlaps and trace lie by A-read, neither segments nor ends are sent.
    """
    c = F.col
    spans = iv.groupBy(c("rid").alias("aread")).agg(F.collect_list(F.struct("beg", "end_")).alias("_iv"))
    kept = ["abeg", "aend", "rid", "comp", "blen"]
    met = o.select("aread", "ovl_id", c("bread").alias("rid"), "comp", "blen", "abpos", "aepos", "bbpos").join(spans, "aread").select("*", F.posexplode("_iv").alias("_k", "_x"))
    cut = met.withColumn("abeg", F.greatest("abpos", "_x.beg")).withColumn("aend", F.least("aepos", "_x.end_")).where(c("aend") - c("abeg") >= least)
    end = lambda pos, last: F.struct(pos.alias("pos"), last.cast("long").alias("tile"))
    sides = F.explode(F.array(end(c("abeg"), F.floor(c("abeg") / twidth)), end(c("aend"), F.floor((c("aend") - 1) / twidth))))
    ends = cut.select("aread", "ovl_id", "_k", sides.alias("_s"), F.struct("abpos", "aepos", "bbpos", *kept).alias("_e")).select("aread", "ovl_id", c("_s.tile").alias("tile"), F.struct("_k", c("_s.pos").alias("pos"), "_e").alias("_e"))
    seg = trace.select("aread", "ovl_id", c("tile").cast("long").alias("tile"), c("blen").cast("long").alias("sl"))
    rows = seg.withColumn("_e", F.lit(None).cast(ends.schema["_e"].dataType)).withColumnRenamed("aread", "_a").unionByName(ends.withColumnRenamed("aread", "_a").withColumn("sl", F.lit(None).cast("long")))
    order = Window.partitionBy("_a", "ovl_id").orderBy("tile", c("sl").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(c("sl").isNotNull(), F.struct("tile", "sl")), ignorenulls=True).over(order)
    rows = rows.withColumn("_to", F.sum("sl").over(order)).withColumn("_seg", last).where(c("_e").isNotNull() & (c("_seg.tile") == c("tile")))
    at = rows.select(c("_a").alias("aread"), "ovl_id", "tile", "_to", c("_seg.sl").alias("sl"), "_e.*").select("*", "_e.*").drop("_e")
    at = at.withColumns({"sa": F.greatest("abpos", c("tile") * twidth), "ea": F.least("aepos", (c("tile") + 1) * twidth), "sb": c("bbpos") + c("_to") - c("sl")})
    # Of both ends the first is where the position is the part's begin; a part is never empty.
    at = at.select("aread", "ovl_id", "_k", *kept, "pos", on_b(c("pos")).alias("_b"))
    both = at.groupBy("aread", "ovl_id", "_k", *kept).agg(F.max(F.when(c("pos") == c("abeg"), c("_b"))).alias("bb"), F.max(F.when(c("pos") == c("aend"), c("_b"))).alias("be")).where("bb < be")
    beg, end = forward_b(c("comp"), c("blen"), c("bb"), c("be"))
    return both.select("ovl_id", "aread", "rid", beg.alias("beg"), end.alias("end_"), "abeg", "aend")


def homogenize(iv: DataFrame, o: DataFrame, trace: DataFrame, trim: DataFrame, min_len: int = 500, ends: int | None = None, res: int = 1) -> DataFrame:
    """Union over all partners of intervals of ``min_len`` or more lifted to each read.

    ``ends``: only what lies in that many bases at the trimmed ends. ``res``: borders go outward to multiples of it.
    """
    lifted = lift_intervals(o.where("aread <> bread"), trace, iv, least=min_len).select("rid", "beg", "end_")
    if ends is not None:
        t = lifted.join(trim.where("tb < te").select("rid", "tb", "te"), "rid")
        parts = F.array(F.struct(F.greatest("beg", "tb").alias("beg"), F.least("end_", F.col("tb") + ends).alias("end_")), F.struct(F.greatest("beg", F.col("te") - ends).alias("beg"), F.least("end_", "te").alias("end_")))
        lifted = t.select("rid", F.inline(parts)).where("beg < end_")
    out = merge_intervals(lifted, by=("rid",))
    return out if res == 1 else merge_intervals(out.select("rid", (F.floor(F.col("beg") / res) * res).alias("beg"), (F.ceil(F.col("end_") / res) * res).alias("end_")), by=("rid",))


def trim_overlaps(o: DataFrame, trace: DataFrame, trim: DataFrame, twidth: int = 100) -> DataFrame:
    """Overlaps cut to the trims of both reads; border segments are cut in proportion. What is left empty is DISCARD and TRIM.

    Differences are those of the segments kept, in proportion to their kept part.
    """
    s = segments(o, trace, twidth).join(with_ends(o, trim).select("ovl_id", "atb", "ate", "btb", "bte"), "ovl_id")
    width = F.col("ea") - F.col("sa")
    head = F.when((F.col("btb") > F.col("sb")) & (F.col("sl") > 0), F.col("sa") + F.ceil((F.col("btb") - F.col("sb")) * width / F.col("sl"))).otherwise(F.col("sa"))
    tail = F.when((F.col("bte") < F.col("eb")) & (F.col("sl") > 0), F.col("ea") - F.ceil((F.col("eb") - F.col("bte")) * width / F.col("sl"))).otherwise(F.col("ea"))
    s = s.withColumn("_lo", F.greatest("sa", "atb", head)).withColumn("_hi", F.least("ea", "ate", tail)).where("_lo < _hi")
    part = F.floor(F.col("sdiffs") * (F.col("_hi") - F.col("_lo")) / width)
    kept = s.groupBy("ovl_id").agg(F.min("_lo").alias("_ab"), F.max("_hi").alias("_ae"), F.min(on_b(F.col("_lo"))).alias("_bb"), F.max(on_b(F.col("_hi"))).alias("_be"), F.sum(part).alias("_d"))
    j = flagged(o).join(kept, "ovl_id", "left")
    gone = F.col("_ab").isNull()
    for old, new in (("abpos", "_ab"), ("aepos", "_ae"), ("bbpos", "_bb"), ("bepos", "_be"), ("diffs", "_d")):
        j = j.withColumn(old, F.coalesce(new, old))
    return j.withColumn("flags", set_flag(set_flag(F.col("flags"), "DISCARD", gone), "TRIM", gone)).drop("_ab", "_ae", "_bb", "_be", "_d")


def edit_blocks(edits: DataFrame, reads: DataFrame) -> DataFrame:
    """Aligned blocks (rid, ob, oe, shift) of reads whose bases were inserted (n > 0) or deleted (n < 0) at old positions ``pos``."""
    w = Window.partitionBy("rid").orderBy("pos")
    marks = edits.select("rid", "pos", "n").unionByName(reads.select("rid", F.lit(0).alias("pos"), F.lit(0).alias("n"))).groupBy("rid", "pos").agg(F.sum("n").alias("n"))
    b = marks.join(reads.select("rid", "rlen"), "rid").withColumn("shift", F.sum("n").over(w)).withColumn("oe", F.coalesce(F.lead("pos").over(w), "rlen"))
    return b.select("rid", (F.col("pos") - F.least("n", F.lit(0))).alias("ob"), "oe", "shift").where("ob < oe")


def lift_corrected(points: DataFrame, edits: DataFrame, reads: DataFrame) -> DataFrame:
    """Positions (rid, pos) of old reads with their place ``new_pos`` on the edited read; null where the base was deleted."""
    spots = points.select("rid", "pos").distinct().withColumn("_pe", F.col("pos") + 1)
    hit = interval_join(spots, edit_blocks(edits, reads), "rid", ("pos", "_pe"), ("ob", "oe")).select("rid", "pos", (F.col("pos") + F.col("shift")).alias("new_pos"))
    return points.join(hit, ["rid", "pos"], "left")


def resolve_names(names: DataFrame, contigs: DataFrame) -> DataFrame:
    """cid, sub_beg, sub_end of ``name`` or ``name_subseq_beg:end``; an unknown name has a null cid."""
    sub = r"^(.*?)(?:_subseq_([0-9]+):([0-9]+))?$"
    part = lambda k: F.regexp_extract("name", sub, k)
    n = names.withColumn("_base", part(1)).withColumn("sub_beg", F.expr("try_cast(nullif(regexp_extract(name, '_subseq_([0-9]+):', 1), '') as long)")).withColumn("sub_end", F.expr("try_cast(nullif(regexp_extract(name, ':([0-9]+)$', 1), '') as long)"))
    return n.join(contigs.select("cid", F.col("name").alias("_base")), "_base", "left").drop("_base")
