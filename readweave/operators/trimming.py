"""Contig trims from overlap chains, optical-map gaps and splits: the parts that stay, and those that go with their reasons.

Evidence is one table: a contig, the side that is cut, where, and what says so. The kept part of a contig is what all of it leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lift import segments

#: A chain of less than this divergence (percent) may hold up to two thirds of a contig.
SIMILAR = 2.0


def middle(o: DataFrame, trace: DataFrame | None, twidth: int = 100) -> DataFrame:
    """ovl_id, cut_a, cut_b: the trace point nearest to the middle of each overlap (the later of two), or the middle itself without a trace."""
    point = F.col("abpos") + F.floor((F.col("aepos") - F.col("abpos")) / 2)
    if trace is None:
        return o.select("ovl_id", point.alias("cut_a"), (F.col("bbpos") + point - F.col("abpos")).alias("cut_b"))
    near = F.floor((F.col("point") + twidth / 2) / twidth).cast("long") * twidth
    p = o.withColumn("point", point).withColumn("near", near)
    start = (F.col("near") <= F.col("abpos")) | (F.col("point") - F.col("abpos") < F.abs(F.col("point") - F.col("near")))
    ends = segments(o, trace, twidth).select("ovl_id", ((F.col("tile") + 1) * twidth).alias("near"), F.col("eb").alias("_b"))
    j = p.join(ends, ["ovl_id", "near"], "left")
    cut_a, cut_b = F.when(start, F.col("abpos")).otherwise(F.col("near")), F.when(start, F.col("bbpos")).otherwise(F.col("_b"))
    return j.select("ovl_id", cut_a.alias("cut_a"), cut_b.alias("cut_b"), "aepos", "bepos").where("cut_a <= aepos and cut_b <= bepos").drop("aepos", "bepos")


def chain_cuts(chains: DataFrame, trace: DataFrame | None = None, fuzz: int = 1500, offset: int = 100) -> DataFrame:
    """Evidence of the overlaps of two contigs (a chain: all overlaps of a pair, from left to right): cid, side (begin, end), pos, other, aligned, unaligned, div.

    A chain counts if its steps on A are at most ``fuzz`` and on one strand (a single overlap: if it reaches within ``fuzz`` of an end of
    both contigs), and if neither contig lies more than half in it on both sides; chains of low divergence and few unaligned bases may
    take up to two thirds. A single overlap cuts at its middle, a longer chain between its first and last overlap; ``offset`` more is kept.
    Each pair says one thing about a side: what comes first in pile order.
    """
    c = F.col
    w = Window.partitionBy("aread", "bread").orderBy("abpos", "aepos", "ovl_id")
    rows = chains.where("aread <> bread")
    for name in ("aepos", "bepos", "comp"):
        rows = rows.withColumn(f"_{name}", F.lag(name).over(w))
    step = F.abs(c("_aepos") - c("abpos"))
    bad = c("_aepos").isNotNull() & ((step > fuzz) | (c("_comp") != c("comp")))
    over_a, over_b = c("_aepos") - c("abpos"), c("_bepos") - c("bbpos")
    rate = 200.0 * c("diffs") / ((c("aepos") - c("abpos")) + (c("bepos") - c("bbpos")))
    first = F.min_by(F.struct("ovl_id", "abpos", "aepos", "bbpos", "bepos", "comp"), F.struct("abpos", "aepos", "ovl_id"))
    last = F.max_by(F.struct("abpos", "aepos", "bbpos", "bepos"), F.struct("abpos", "aepos", "ovl_id"))

    def inner(over: Column, sign: int) -> Column:
        return F.sum(F.greatest(F.coalesce(over * sign, F.lit(0)), F.lit(0)))

    g = rows.groupBy("aread", "bread").agg(
        F.first("alen").alias("alen"), F.first("blen").alias("blen"), F.count(F.lit(1)).alias("n"), first.alias("f"), last.alias("l"), F.count_if(bad).alias("bad"), F.avg(rate).alias("div"),
        (F.sum(c("aepos") - c("abpos")) - inner(over_a, 1)).alias("al_a"), (F.sum(c("bepos") - c("bbpos")) - inner(over_b, 1)).alias("al_b"), inner(over_a, -1).alias("un_a"), inner(over_b, -1).alias("un_b"),
    )
    lone = c("n") == 1
    tail_a, tail_b = c("alen") - c("l.aepos"), c("blen") - c("l.bepos")
    g = g.withColumn("un_a", F.when(lone, F.when(c("f.abpos") < tail_a, c("f.abpos")).otherwise(tail_a)).otherwise(c("un_a") + F.least("f.abpos", tail_a)))
    g = g.withColumn("un_b", F.when(lone, F.when(c("f.bbpos") < tail_b, c("f.bbpos")).otherwise(tail_b)).otherwise(c("un_b") + F.least("f.bbpos", tail_b)))
    loose = ((c("f.abpos") > fuzz) & (tail_a > fuzz)) | ((c("f.bbpos") > fuzz) & (tail_b > fuzz))
    half = ((c("f.abpos") <= F.floor(c("alen") / 2)) & (tail_a <= F.floor(c("alen") / 2))) | ((c("f.bbpos") <= F.floor(c("blen") / 2)) & (tail_b <= F.floor(c("blen") / 2)))
    third = ((c("f.abpos") >= F.floor(c("alen") / 3)) | (tail_a >= F.floor(c("alen") / 3))) & ((c("f.bbpos") >= F.floor(c("blen") / 3)) | (tail_b >= F.floor(c("blen") / 3)))
    close = (c("div") < SIMILAR) & (c("un_a") < fuzz) & (c("un_b") < fuzz) & third
    ok = F.when(lone, ~loose & ~half).otherwise((c("bad") == 0) & (~half | close)) & (c("f.abpos") != tail_a) & (c("f.bbpos") != tail_b)
    g = g.where(ok).withColumn("ovl_id", c("f.ovl_id"))
    singles = rows.join(g.where(lone).select("ovl_id"), "ovl_id", "left_semi").select("ovl_id", "abpos", "aepos", "bbpos", "bepos")
    cuts = middle(singles, trace)
    g = g.join(cuts, "ovl_id", "left").where(~lone | c("cut_a").isNotNull())

    def place(begins: Column, near: Column, far: Column, mid: Column) -> Column:
        return F.when(begins, F.when(lone, mid).otherwise(F.greatest(near, far)) + offset).otherwise(F.when(lone, mid).otherwise(F.least(near, far)) - offset)

    begin_a, begin_b = c("f.abpos") < tail_a, c("f.bbpos") < tail_b
    at_a, at_b = place(begin_a, c("f.aepos"), c("l.abpos"), c("cut_a")), place(begin_b, c("f.bepos"), c("l.bbpos"), c("cut_b"))
    turned = c("f.comp") == 1
    side = lambda b: F.when(b, "begin").otherwise("end")
    mine = F.struct(c("aread").alias("cid"), c("bread").alias("other"), side(begin_a).alias("side"), at_a.cast("long").alias("pos"), c("al_a").alias("aligned"), c("un_a").alias("unaligned"))
    theirs = F.struct(c("bread").alias("cid"), c("aread").alias("other"), side(begin_b != turned).alias("side"), F.when(turned, c("blen") - at_b).otherwise(at_b).cast("long").alias("pos"), c("al_b").alias("aligned"), c("un_b").alias("unaligned"))
    both = g.select("aread", "bread", "div", F.explode(F.array(mine, theirs)).alias("e")).select("aread", "bread", "div", "e.*")
    one = both.groupBy("cid", "other", "side").agg(F.min_by(F.struct("pos", "aligned", "unaligned", "div"), F.struct("aread", "bread")).alias("x"))
    return one.select("cid", "other", "side", "x.*")


def both_ways(gaps: DataFrame) -> DataFrame:
    """Gap rows (cid, a_beg, a_end, other, b_beg, b_end, gap) as each of the two contigs sees them."""
    back = gaps.select(F.col("other").alias("cid"), F.col("b_end").alias("a_beg"), F.col("b_beg").alias("a_end"), F.col("cid").alias("other"), F.col("a_end").alias("b_beg"), F.col("a_beg").alias("b_end"), "gap")
    return gaps.select(*back.columns).unionByName(back)


def gap_cuts(gaps: DataFrame, contigs: DataFrame, below: int = 0, offset: int = 100, unsplit: bool = False) -> DataFrame:
    """Evidence of gaps smaller than ``below`` at a contig's first (1) or last base: half of the gap and ``offset`` go.

    ``unsplit``: only gaps whose other side is an end as well (of B's first base, or where A's part begins at A's last base).
    """
    g = both_ways(gaps).where(F.col("gap") < below).join(contigs.select("cid", "len"), "cid")
    size = 1 + F.floor(F.abs("gap") / 2) + offset
    side = F.when(F.col("a_end") == 1, "begin").when(F.col("a_end") == F.col("len"), "end")
    if unsplit:
        g = g.where((F.col("b_beg") == 1) | (F.col("a_beg") == F.col("len")))
    pos = F.when(side == "begin", size).otherwise(F.col("len") - size)
    return g.select("cid", "other", side.alias("side"), pos.cast("long").alias("pos"), F.least("a_beg", "a_end").alias("from"), F.greatest("a_beg", "a_end").alias("to")).where("side is not null")


def trim_contigs(contigs: DataFrame, option: int, splits: DataFrame | None = None, gaps: DataFrame | None = None, chains: DataFrame | None = None, trace: DataFrame | None = None, below: int = 0, fuzz: int = 1500, offset: int = 100) -> DataFrame:
    """cid, kind (kept, removed), beg, end_, reason, other: the parts of all contigs (cid, len).

    Options: 0, the parts of ``splits`` (cid, beg, end_) stay; 1, negative gaps; 2, negative gaps at ends that were not split, each on the
    part of ``splits`` that it touches; 3, chains. A contig without evidence is kept whole; one that is cut from both sides beyond itself
    goes. reason: split, gap or chain; other: the contig that the cut comes from (the smallest, of several; null for splits).
    """
    whole = contigs.select("cid", "len", F.lit(0).cast("long").alias("beg"), F.col("len").cast("long").alias("end_"))
    if option in (0, 2):
        own = splits.join(contigs.select("cid", "len"), "cid").select("cid", "len", F.col("beg").cast("long").alias("beg"), F.col("end_").cast("long").alias("end_"))
        parts = own.unionByName(whole.join(splits.select("cid"), "cid", "left_anti"))
    else:
        parts = whole
    if option == 0:
        cuts = None
    elif option == 3:
        cuts = chain_cuts(chains, trace, fuzz, offset).select("cid", "other", "side", "pos", F.lit("chain").alias("why"))
    else:
        cuts = gap_cuts(gaps, contigs, below, offset, unsplit=option == 2).withColumn("why", F.lit("gap"))
    c = F.col
    if cuts is not None:
        j = parts.join(cuts, "cid") if option != 2 else parts.join(cuts, "cid").where((c("beg") < c("to")) & (c("from") < c("end_")))
        from_left, from_right = c("side") == "begin", c("side") == "end"
        best = j.groupBy("cid", "beg", "end_").agg(
            F.max(F.when(from_left, F.struct("pos", (-c("other")).alias("by"), "why"))).alias("lo"),
            F.min(F.when(from_right, F.struct("pos", c("other").alias("by"), "why"))).alias("hi"),
        )
        parts = parts.join(best, ["cid", "beg", "end_"], "left")
        low = F.when(c("lo.pos") > c("beg"), c("lo.pos")).otherwise(c("beg"))
        high = F.when(c("hi.pos") < c("end_"), c("hi.pos")).otherwise(c("end_"))
        empty = low >= high
        parts = parts.select(
            "cid", "len", "beg", "end_", F.when(empty, c("end_")).otherwise(low).alias("lo"), F.when(empty, c("end_")).otherwise(high).alias("hi"),
            F.when(low > c("beg"), F.struct(c("lo.why").alias("reason"), (-c("lo.by")).alias("other"))).when(empty, F.struct(c("hi.why").alias("reason"), c("hi.by").alias("other"))).alias("left"),
            F.when(high < c("end_"), F.struct(c("hi.why").alias("reason"), c("hi.by").alias("other"))).alias("right"),
        )
    else:
        none = F.lit(None).cast("struct<reason: string, other: bigint>")
        parts = parts.select("cid", "len", "beg", "end_", c("beg").alias("lo"), c("end_").alias("hi"), none.alias("left"), none.alias("right"))
    kept = parts.where("lo < hi").select("cid", F.lit("kept").alias("kind"), c("lo").alias("beg"), c("hi").alias("end_"), F.lit(None).cast("string").alias("reason"), F.lit(None).cast("long").alias("other"))
    pieces = F.array(F.struct(c("beg").alias("beg"), c("lo").alias("end_"), c("left").alias("w")), F.struct(c("hi").alias("beg"), c("end_").alias("end_"), c("right").alias("w")))
    gone = parts.select("cid", F.inline(pieces)).where("beg < end_").select("cid", F.lit("removed").alias("kind"), "beg", "end_", "w.reason", "w.other")
    # What lies between the parts of a split contig, and before and behind them.
    w = Window.partitionBy("cid").orderBy("beg", "end_")
    edges = parts.withColumn("_from", F.coalesce(F.max("end_").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("_to", F.lead("beg").over(w))
    holes = edges.select("cid", F.inline(F.array(F.struct(c("_from").alias("beg"), c("beg").alias("end_")), F.struct(F.when(c("_to").isNull(), c("end_")).alias("beg"), F.when(c("_to").isNull(), c("len")).cast("long").alias("end_"))))).where("beg < end_")
    return kept.unionByName(gone).unionByName(holes.select("cid", F.lit("removed").alias("kind"), "beg", "end_", F.lit("split").alias("reason"), F.lit(None).cast("long").alias("other")))


def trim_totals(parts: DataFrame) -> DataFrame:
    """cid, new_len, trim_begin, trim_end: bases that stay, and those removed before the first and behind the last kept part (of a contig that keeps nothing: all before)."""
    first, last = F.min(F.when(F.col("kind") == "kept", F.col("beg"))), F.max(F.when(F.col("kind") == "kept", F.col("end_")))
    size = F.max("end_")
    kept = F.coalesce(F.sum(F.when(F.col("kind") == "kept", F.col("end_") - F.col("beg"))), F.lit(0))
    return parts.groupBy("cid").agg(kept.alias("new_len"), F.coalesce(first, size).alias("trim_begin"), F.coalesce(size - last, F.lit(0)).alias("trim_end"))
