"""Patching and correcting reads with pieces of the reads that overlap them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readweave.functions.columns import reverse_complement

from .intervals import interval_join, merge_intervals
from .letters import vote_columns
from .lift import piled_segments


def break_candidates(o: DataFrame, twidth: int = 100, ratio: int = 10, spanners: int = 7, anchor: int = 400) -> DataFrame:
    """Gaps in A between consecutive overlaps of one B and strand, grown to tiles: (aread, bread, comp, beg, end_, bb, be).

    Rejected: a gap in B more than ``ratio`` times that in A, and gaps that more than ``spanners`` overlaps span by ``anchor`` bases.
    """
    use = o.where("aread <> bread")
    w = Window.partitionBy("aread", "bread", "comp").orderBy("abpos", "aepos", "ovl_id")
    n = use.withColumn("_nab", F.lead("abpos").over(w)).withColumn("_nbb", F.lead("bbpos").over(w))
    g = n.where("_nab > aepos and _nbb >= bepos").where((F.col("_nbb") - F.col("bepos")) <= ratio * (F.col("_nab") - F.col("aepos")))
    g = g.select("aread", "bread", "comp", (F.floor(F.col("aepos") / twidth) * twidth).alias("beg"), (F.ceil(F.col("_nab") / twidth) * twidth).alias("end_"), F.col("bepos").alias("bb"), F.col("_nbb").alias("be"))
    spots = g.select(F.col("aread").alias("rid"), "beg", "end_").distinct()
    over = use.select(F.col("aread").alias("rid"), (F.col("abpos") + anchor).alias("ob"), (F.col("aepos") - anchor).alias("oe")).where("ob < oe")
    many = interval_join(spots, over, "rid", ("beg", "end_"), ("ob", "oe")).where("ob <= beg and oe >= end_").groupBy(F.col("rid").alias("aread"), "beg", "end_").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > spanners)
    return g.join(many, ["aread", "beg", "end_"], "left_anti")


def merge_breaks(c: DataFrame, like: int = 50, max_gap: int = 500, support: int = 4) -> DataFrame:
    """Breaks with their support: candidates of one A interval with B lengths less than ``like`` apart count together; of overlapping breaks the best supported stays, with the sum."""
    length = c.withColumn("_bl", F.col("be") - F.col("bb"))
    w = Window.partitionBy("aread", "beg", "end_").orderBy("_bl")
    new = F.coalesce(F.col("_bl") - F.lag("_bl").over(w) >= like, F.lit(True)).cast("int")
    kinds = length.withColumn("_k", new).withColumn("_k", F.sum("_k").over(w)).groupBy("aread", "beg", "end_", "_k").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_bl", "bread", "comp", "bb", "be")).alias("b"))
    run = Window.partitionBy("aread").orderBy("beg", "end_", "_k")
    before = F.max("end_").over(run.rowsBetween(Window.unboundedPreceding, -1))
    isl = kinds.withColumn("_new", F.when(F.col("beg") < before, 0).otherwise(1)).withColumn("_g", F.sum("_new").over(run))
    best = isl.groupBy("aread", "_g").agg(F.max_by(F.struct("beg", "end_", "b"), F.struct("n", -F.col("beg"), -F.col("end_"), -F.col("_k"))).alias("m"), F.sum("n").alias("support"))
    flat = best.select("aread", "m.beg", "m.end_", "m.b.bread", "m.b.comp", "m.b.bb", "m.b.be", "support")
    return flat.where((F.col("support") >= support) & (F.col("end_") - F.col("beg") < max_gap))


def tile_pile(o: DataFrame, trace: DataFrame, cap: int = 40, use: int = 20, twidth: int = 100) -> DataFrame:
    """The best ``use`` of the first ``cap`` segments by differences on each whole tile of A: (aread, tile, ovl_id, bread, comp, blen, sb, eb, sdiffs, k)."""
    j = piled_segments(o.where("aread <> bread"), trace, twidth, ("bread", "comp", "blen")).where(F.col("ea") - F.col("sa") == twidth)
    w = Window.partitionBy("aread", "tile").orderBy("sdiffs", "ovl_id")
    return j.withColumn("k", F.row_number().over(w)).where(F.col("k") <= min(cap, use)).select("aread", "tile", "ovl_id", "bread", "comp", "blen", "sb", "eb", "sdiffs", "k")


def own_tiles(twidth: int) -> Column:
    """Of each row of a pile: it, and of the first row of a tile (k = 1) A's own letters too, as structs (bread, comp, sb, eb, own)."""
    it = lambda own, b, comp, sb, eb: F.struct(b.cast("long").alias("bread"), comp.cast("int").alias("comp"), sb.cast("long").alias("sb"), eb.cast("long").alias("eb"), F.lit(own).alias("own"))
    tile = F.col("tile") * twidth
    return F.when(F.col("k") == 1, F.array(it(0, *map(F.col, ("bread", "comp", "sb", "eb"))), it(1, F.col("aread"), F.lit(0), tile, tile + twidth))).otherwise(F.array(it(0, *map(F.col, ("bread", "comp", "sb", "eb")))))


def piece_votes(pile: DataFrame, reads: DataFrame, twidth: int) -> DataFrame:
    """aread, tile, piece, own: the letters of each segment of a pile on A's strand, and A's own for each tile; they lie by A-read.

    A segment's letters are cut from the read before they are turned, and go to their A-read once.
    """
    c = F.col
    if "k" not in pile.columns:
        pile = pile.withColumn("k", F.row_number().over(Window.partitionBy("aread", "tile").orderBy("ovl_id")))
    # Bytes are cut without counting letters from the begin; reads with other letters than ASCII are cut as text.
    r = reads.select(c("rid").cast("long").alias("bread"), "seq", (F.octet_length("seq") == F.length("seq")).alias("_plain"), F.length("seq").cast("long").alias("_l"))
    p = pile.select("aread", "tile", F.explode(own_tiles(twidth)).alias("_x")).select("aread", "tile", "_x.*")
    beg = F.when(c("comp") == 1, F.greatest(c("_l") - c("eb"), F.lit(0))).otherwise(c("sb"))
    end = F.when(c("comp") == 1, c("_l") - c("sb")).otherwise(c("eb"))
    j = p.join(r, "bread").withColumn("_f", (beg + 1).cast("int")).withColumn("_n", F.greatest(end - beg, F.lit(0)).cast("int"))
    cut = F.when(c("_plain"), F.substr(c("seq").cast("binary"), c("_f"), c("_n")).cast("string")).otherwise(F.substr("seq", c("_f"), c("_n")))
    return j.select("aread", "tile", F.when(c("comp") == 1, reverse_complement(cut)).otherwise(cut).alias("piece"), "own").repartition("aread")


def tile_consensus(pile: DataFrame, reads: DataFrame, twidth: int = 100) -> DataFrame:
    """aread, tile, seq, used: the most frequent B segment of each tile; on a tie A's own, then the first in letters."""
    n = piece_votes(pile, reads, twidth).groupBy("aread", "tile", "piece").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("own"))
    w = Window.partitionBy("aread", "tile").orderBy(F.desc("n"), F.desc("own"), "piece")
    return n.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("aread", "tile", F.col("piece").alias("seq"), F.col("n").alias("used"))


def column_consensus(pile: DataFrame, reads: DataFrame, twidth: int = 100, chunk: int = 500) -> DataFrame:
    """aread, tile, seq, used: a vote for each column among the segments of a tile that have its most frequent length; A's own has a vote.

    Of equally frequent lengths A's own wins, then the shorter; of equally frequent letters A's own (if its length was chosen), then the first in the alphabet.
    Votes come to a task sorted by tile, and many tiles are counted at once. ``chunk`` has no effect any more: reads are not cut into chunks.
    """
    votes = piece_votes(pile, reads, twidth).where("piece <> ''").select(F.col("aread").cast("long"), F.col("tile").cast("long"), "piece", "own")
    return votes.sortWithinPartitions("aread", "tile").mapInArrow(vote_columns, "aread long, tile long, seq string, used long")


def assemble_corrected(tiles: DataFrame) -> DataFrame:
    """rid, first_tile, last_tile, used, seq: each read's tiles put together in order."""
    g = tiles.groupBy(F.col("aread").alias("rid")).agg(F.array_sort(F.collect_list(F.struct("tile", "seq", "used"))).alias("_t"))
    return g.select("rid", F.element_at("_t", 1)["tile"].alias("first_tile"), F.element_at("_t", -1)["tile"].alias("last_tile"), F.transform("_t", lambda x: x["used"]).alias("used"), F.concat_ws("", F.transform("_t", lambda x: x["seq"])).alias("seq"))


def weak_tiles(pile: DataFrame, tile_q: DataFrame, breaks: DataFrame, worst: int = 28) -> DataFrame:
    """For tiles with q = 0 or q >= ``worst`` outside breaks, the segment with fewest differences: (aread, tile, bread, comp, sb, eb)."""
    # A read's breaks meet its tiles as one array; marks of weak tiles stand beside the pile, so that neither is sent where they lie by A-read.
    c = F.col
    off = breaks.where("beg < end_").groupBy("aread").agg(F.collect_list(F.struct("beg", "end_")).alias("_off"))
    weak = tile_q.where(f"q = 0 or q >= {worst}").select(c("rid").alias("_a"), c("tile").cast("long").alias("tile")).join(off.withColumnRenamed("aread", "_a"), "_a", "left")
    left = weak.where(~F.coalesce(F.exists("_off", lambda x: (x["beg"] < c("tile") * 100 + 100) & (x["end_"] > c("tile") * 100)), F.lit(False)))
    best = pile.where("k = 1").select(c("aread").alias("_a"), c("tile").cast("long").alias("tile"), F.struct("bread", "comp", "sb", "eb").alias("_p"))
    rows = best.unionByName(left.select("_a", "tile", F.lit(None).cast(best.schema["_p"].dataType).alias("_p")))
    both = rows.groupBy("_a", "tile").agg(F.first("_p", ignorenulls=True).alias("_p"), F.count_if(c("_p").isNull()).alias("_n")).where((c("_n") > 0) & c("_p").isNotNull())
    return both.select(c("_a").alias("aread"), "tile", "_p.*")


def kept_pieces(patches: DataFrame, reads: DataFrame, trim: DataFrame) -> DataFrame:
    """What stays of each trimmed read between its patches (aread, beg, end_, bread, comp, bb, be): (rid, beg, end_, at), ``at`` the place on the new read."""
    t = trim.where("tb < te").select("rid", "tb", "te")
    marks = patches.select(F.col("aread").alias("rid"), "beg", "end_", (F.col("be") - F.col("bb")).alias("put")).join(t, "rid").where("beg >= tb and end_ <= te")
    w = Window.partitionBy("rid").orderBy("beg", "end_")
    stops = marks.unionByName(t.select("rid", F.col("te").alias("beg"), F.col("te").alias("end_"), F.lit(0).alias("put"), "tb", "te"))
    s = stops.withColumn("_from", F.coalesce(F.lag("end_").over(w), "tb")).withColumn("_put", F.sum("put").over(w) - F.col("put"))
    s = s.withColumn("_len", F.col("beg") - F.col("_from")).withColumn("at", F.sum("_len").over(w) - F.col("_len") + F.col("_put"))
    return s.where("_len > 0").select("rid", F.col("_from").alias("beg"), F.col("beg").alias("end_"), "at")


def apply_patches(reads: DataFrame, patches: DataFrame, trim: DataFrame, min_len: int = 1000, cols: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Patched reads of ``min_len`` or more: kept pieces of A and patches from B in order. Columns besides ``seq`` (qualities) are reversed, not complemented.

    Patches of one read must not overlap; those outside the trim are left out.
    """
    own = kept_pieces(patches, reads, trim).join(reads.select("rid", *cols), "rid")
    a = own.select("rid", F.col("beg").alias("_at"), *(F.expr(f"substring({c}, cast(beg as int) + 1, cast(end_ - beg as int))").alias(c) for c in cols))
    t = trim.where("tb < te").select(F.col("rid").alias("aread"), "tb", "te")
    b = patches.join(t, "aread").where("beg >= tb and end_ <= te").join(reads.select(F.col("rid").alias("bread"), *cols), "bread")
    for c in cols:
        flip = reverse_complement(F.col(c)) if c == "seq" else F.reverse(c)
        b = b.withColumn(c, F.when(F.col("comp") == 1, flip).otherwise(F.col(c)))
    b = b.select(F.col("aread").alias("rid"), F.col("beg").alias("_at"), *(F.expr(f"substring({c}, cast(bb as int) + 1, cast(be - bb as int))").alias(c) for c in cols))
    g = a.unionByName(b).groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("_at", *cols))).alias("_p"))
    return g.select("rid", *(F.concat_ws("", F.col(f"_p.{c}")).alias(c) for c in cols)).where(F.length("seq") >= min_len)


def shift_intervals(iv: DataFrame, pieces: DataFrame, shortest: int = 6) -> DataFrame:
    """Intervals on patched reads: parts on kept pieces move along, touching parts join, parts below ``shortest`` bases go."""
    p = pieces.select("rid", F.col("beg").alias("pb"), F.col("end_").alias("pe"), "at")
    j = interval_join(iv, p, "rid", ("beg", "end_"), ("pb", "pe")).where(F.col("bp") >= shortest)
    moved = j.select("track", "rid", (F.greatest("beg", "pb") - F.col("pb") + F.col("at")).alias("beg"), (F.least("end_", "pe") - F.col("pb") + F.col("at")).alias("end_"))
    return merge_intervals(moved)
