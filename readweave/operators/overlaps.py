"""Pairwise overlaps: rules that set flags, coverage, trims, pair groups, statistics.

Rows are (ovl_id, aread, bread, comp, alen, blen, abpos, aepos, bbpos, bepos, diffs[, flags]). Operators that
set flags keep all rows; ``purge`` drops the discarded ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readweave.functions.columns import forward_b, has, set_flag

from .intervals import interval_join, merge_intervals, sweep
from .numbering import sums_before

ORDER = ["aread", "bread", "comp", "abpos", "aepos", "bbpos", "bepos"]


def flagged(o: DataFrame) -> DataFrame:
    return o if "flags" in o.columns else o.withColumn("flags", F.lit(0))


def discard(o: DataFrame, reason: str, when: Column) -> DataFrame:
    return o.withColumn("flags", set_flag(set_flag(F.col("flags"), reason, when), "DISCARD", when))


def purge(o: DataFrame) -> DataFrame:
    return o.where(~has(F.col("flags"), "DISCARD"))


def sort_overlaps(o: DataFrame) -> DataFrame:
    """Canonical order, by ranges of A-reads."""
    key = [*ORDER, *(c for c in ("ovl_id",) if c in o.columns)]
    return o.repartitionByRange("aread").sortWithinPartitions(*key)


def with_ends(o: DataFrame, trim: DataFrame) -> DataFrame:
    """Adds atb, ate, btb, bte; B's trim lies on the strand of the overlap. A read without a trim row is gone: (0, 0)."""
    t = trim.select("rid", "tb", "te")
    a = o.join(t.toDF("aread", "_atb", "_ate"), "aread", "left")
    b = a.join(t.toDF("bread", "_btb", "_bte"), "bread", "left")
    none = lambda x, y, c: F.when(F.col(x) < F.col(y), F.col(c)).otherwise(F.lit(0))
    b = b.withColumn("atb", none("_atb", "_ate", "_atb")).withColumn("ate", none("_atb", "_ate", "_ate"))
    b = b.withColumn("_b", none("_btb", "_bte", "_btb")).withColumn("_e", none("_btb", "_bte", "_bte"))
    live, flip = F.col("_b") < F.col("_e"), F.col("comp") == 1
    b = b.withColumn("btb", F.when(live & flip, F.col("blen") - F.col("_e")).otherwise(F.col("_b")))
    b = b.withColumn("bte", F.when(live & flip, F.col("blen") - F.col("_b")).otherwise(F.col("_e")))
    return b.drop("_atb", "_ate", "_btb", "_bte", "_b", "_e")


def filter_overlaps(o: DataFrame, trim: DataFrame, min_rlen: int = 2500, min_olen: int = 800, max_unaligned: int = 500, max_div: float = 0.08) -> DataFrame:
    """A bit for each rule that fails: RLEN (trimmed reads), OLEN (spans), LOCAL (overhang of both reads at one end), DIFF."""
    e = with_ends(flagged(o), trim)
    c = F.col
    rlen = (c("ate") - c("atb") < min_rlen) | (c("bte") - c("btb") < min_rlen)
    olen = (c("aepos") - c("abpos") < min_olen) | (c("bepos") - c("bbpos") < min_olen)
    left = (c("abpos") - c("atb") > max_unaligned) & (c("bbpos") - c("btb") > max_unaligned)
    right = (c("ate") - c("aepos") > max_unaligned) & (c("bte") - c("bepos") > max_unaligned)
    div = c("diffs") / F.least(c("aepos") - c("abpos"), c("bepos") - c("bbpos")) > max_div
    for name, rule in (("RLEN", rlen), ("OLEN", olen), ("LOCAL", left | right), ("DIFF", div)):
        e = discard(e, name, rule)
    return e.drop("atb", "ate", "btb", "bte")


def filter_repeat(o: DataFrame, iv: DataFrame, n: int) -> DataFrame:
    """REPEAT where A or, if A passes, B keeps fewer than ``n`` bases of the overlap outside its intervals."""
    merged = merge_intervals(iv, by=("rid",))
    o = flagged(o)
    bb, be = forward_b(F.col("comp"), F.col("blen"), F.col("bbpos"), F.col("bepos"))
    sides = o.select("ovl_id", F.lit("a").alias("side"), F.col("aread").alias("rid"), F.col("abpos").alias("b"), F.col("aepos").alias("e")).unionByName(
        o.select("ovl_id", F.lit("b").alias("side"), F.col("bread").alias("rid"), bb.alias("b"), be.alias("e"))
    )
    inside = interval_join(sides, merged, "rid", ("b", "e"), ("beg", "end_")).groupBy("ovl_id").agg(F.sum(F.when(F.col("side") == "a", F.col("bp"))).alias("_a"), F.sum(F.when(F.col("side") == "b", F.col("bp"))).alias("_b"))
    j = o.join(inside, "ovl_id", "left")
    few = (F.col("aepos") - F.col("abpos") - F.coalesce("_a", F.lit(0)) < n) | (F.col("bepos") - F.col("bbpos") - F.coalesce("_b", F.lit(0)) < n)
    return discard(j, "REPEAT", few).drop("_a", "_b")


def filter_trace(o: DataFrame, trace: DataFrame) -> DataFrame:
    """Overlaps whose segment lengths in B don't add up."""
    total = trace.groupBy("ovl_id").agg(F.sum("blen").alias("_s"))
    return o.join(total, "ovl_id", "left").where(F.col("bbpos") + F.coalesce("_s", F.lit(0)) != F.col("bepos")).drop("_s")


def filter_segment_error(o: DataFrame, trace: DataFrame, pct: int) -> DataFrame:
    """DIFF where a segment other than the last has more than ``pct`` percent differences."""
    last = Window.partitionBy("ovl_id")
    bad = trace.withColumn("_l", F.max("seg").over(last)).where((F.col("seg") < F.col("_l")) & (100 * F.col("diffs") > pct * F.col("blen"))).select("ovl_id").distinct().withColumn("_bad", F.lit(True))
    return discard(flagged(o).join(bad, "ovl_id", "left"), "DIFF", F.coalesce("_bad", F.lit(False))).drop("_bad")


def downsample(o: DataFrame, reads: DataFrame, pct: int) -> DataFrame:
    """Pairs with both ids among the first ``pct`` percent of the reads."""
    most = reads.agg(F.floor(F.count(F.lit(1)) * pct / 100).alias("_m"))
    return o.crossJoin(F.broadcast(most)).where("aread <= _m and bread <= _m").drop("_m")


def remove_overlaps(o: DataFrame, kinds: list[str]) -> DataFrame:
    """DISCARD of stitched, module, identity or non-identity overlaps."""
    rules = {"stitched": has(F.col("flags"), "STITCH"), "module": has(F.col("flags"), "MODULE"), "identity": F.col("aread") == F.col("bread"), "non_identity": F.col("aread") != F.col("bread")}
    hit = F.lit(False)
    for k in kinds:
        hit = hit | rules[k]
    o = flagged(o)
    return o.withColumn("flags", set_flag(F.col("flags"), "DISCARD", hit))


def show_overlaps(o: DataFrame, min_rlen: int = 0, min_olen: int = 0, min_identity: float = 0, ranges: list[tuple[int, int]] | None = None, self_only: bool = False) -> DataFrame:
    """Rows for display, with identity."""
    ident = 100 - F.floor(100 * F.col("diffs") / (F.col("aepos") - F.col("abpos")))
    d = o.withColumn("identity", ident).where((F.col("alen") >= min_rlen) & (F.col("blen") >= min_rlen) & (F.col("aepos") - F.col("abpos") >= min_olen) & (F.col("identity") >= min_identity))
    if ranges:
        hit = F.lit(False)
        for a, b in ranges:
            hit = hit | F.col("aread").between(a, b)
        d = d.where(hit)
    return d.where("aread = bread") if self_only else d


def check_overlaps(o: DataFrame) -> DataFrame:
    """One row for each rule an overlap breaks: bounds, empty spans, repeats of the row before."""
    w = Window.partitionBy("aread", "bread").orderBy(*ORDER[2:], "ovl_id")
    same = F.struct("comp", "abpos", "aepos", "bbpos", "bepos")
    rules = F.array(
        F.when((F.col("abpos") < 0) | (F.col("aepos") > F.col("alen")), F.lit("a_bounds")),
        F.when((F.col("bbpos") < 0) | (F.col("bepos") > F.col("blen")), F.lit("b_bounds")),
        F.when((F.col("abpos") >= F.col("aepos")) | (F.col("bbpos") >= F.col("bepos")), F.lit("empty")),
        F.when(F.col("_dup"), F.lit("duplicate")),
    )
    d = o.withColumn("_dup", F.coalesce(F.lag(same).over(w) == same, F.lit(False)))
    return d.select("ovl_id", F.explode(F.array_compact(rules)).alias("rule"))


def extract_overlaps(o: DataFrame, rids: DataFrame) -> DataFrame:
    return o.join(rids.select(F.col("rid").alias("aread")), "aread", "left_semi")


def include_exclude(o: DataFrame, include: DataFrame, exclude: DataFrame) -> DataFrame:
    """DISCARD where A or B is excluded, or neither is included."""
    mark = lambda df, key, name: df.select(F.col("rid").alias(key)).distinct().withColumn(name, F.lit(True))
    j = flagged(o)
    for df, name in ((include, "_i"), (exclude, "_x")):
        j = j.join(mark(df, "aread", f"{name}a"), "aread", "left").join(mark(df, "bread", f"{name}b"), "bread", "left")
    out = F.coalesce("_xa", "_xb", F.lit(False)) | ~F.coalesce("_ia", "_ib", F.lit(False))
    return j.withColumn("flags", set_flag(F.col("flags"), "DISCARD", out)).drop("_ia", "_ib", "_xa", "_xb")


def discarded_pairs(o: DataFrame) -> DataFrame:
    return o.where(has(F.col("flags"), "DISCARD")).select(F.least("aread", "bread").alias("r1"), F.greatest("aread", "bread").alias("r2")).distinct()


def sym_discard(o: DataFrame, pairs: DataFrame) -> DataFrame:
    """SYMDISCARD where the pair stands in a list of discarded pairs, whichever read comes first."""
    p = pairs.select("r1", "r2").distinct().withColumn("_p", F.lit(True))
    j = flagged(o).withColumn("r1", F.least("aread", "bread")).withColumn("r2", F.greatest("aread", "bread")).join(p, ["r1", "r2"], "left")
    return discard(j, "SYMDISCARD", F.coalesce("_p", F.lit(False))).drop("_p", "r1", "r2")


def contained_reads(o: DataFrame, trim: DataFrame, fuzz: int = 0) -> DataFrame:
    """Reads whose trimmed part one overlap covers within ``fuzz``, as A or as B."""
    e = with_ends(flagged(o), trim).where(~has(F.col("flags"), "DISCARD")).where("aread <> bread")
    a = e.where((F.col("atb") < F.col("ate")) & (F.col("abpos") <= F.col("atb") + fuzz) & (F.col("aepos") >= F.col("ate") - fuzz)).select(F.col("aread").alias("rid"))
    b = e.where((F.col("btb") < F.col("bte")) & (F.col("bbpos") <= F.col("btb") + fuzz) & (F.col("bepos") >= F.col("bte") - fuzz)).select(F.col("bread").alias("rid"))
    return a.unionByName(b).distinct()


def overlap_stats(o: DataFrame, bin_: int = 500) -> DataFrame:
    """Histogram of A spans: forward, complement and identity counts, bases, and sums from the longest bin on."""
    span = F.col("aepos") - F.col("abpos")
    h = o.withColumn("bin", F.floor(span / bin_) * bin_).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("comp") == 1).alias("n_comp"), F.count_if(F.col("aread") == F.col("bread")).alias("n_identity"), F.sum(span).alias("bases")
    )
    w = Window.orderBy(F.desc("bin"))  # one row for each bin
    return h.withColumn("cum_n", F.sum("n").over(w)).withColumn("cum_bases", F.sum("bases").over(w))


def filter_summary(o: DataFrame) -> DataFrame:
    """Overlaps by reason, over all flags."""
    names = F.array(*(F.when(has(F.col("flags"), n), F.lit(n)) for n in ("DISCARD", "REPEAT", "LOCAL", "DIFF", "SYMDISCARD", "OLEN", "RLEN", "CONT", "GAP", "TRIM")))
    return o.select(F.explode(F.array_compact(names)).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def tile_coverage(o: DataFrame, twidth: int = 100) -> DataFrame:
    """Overlaps that touch each tile of each A-read."""
    tiles = F.explode(F.sequence(F.floor(F.col("abpos") / twidth), F.floor((F.col("aepos") - 1) / twidth)))
    return o.select("aread", tiles.alias("tile")).groupBy("aread", "tile").agg(F.count(F.lit(1)).alias("cov"))


def read_coverage(o: DataFrame, min_aln: int = 0) -> DataFrame:
    """cov = aligned bases over covered bases of each A-read, whole numbers; identity overlaps don't count."""
    use = o.where((F.col("aread") != F.col("bread")) & (F.col("aepos") - F.col("abpos") >= min_aln))
    bases = use.groupBy("aread").agg(F.sum(F.col("aepos") - F.col("abpos")).alias("bases"))
    active = merge_intervals(use.select(F.col("aread").alias("rid"), F.col("abpos").alias("beg"), F.col("aepos").alias("end_")), by=("rid",)).groupBy("rid").agg(F.sum(F.col("end_") - F.col("beg")).alias("active"))
    return bases.join(active.withColumnRenamed("rid", "aread"), "aread").withColumn("cov", F.floor(F.col("bases") / F.col("active")))


def coverage_estimate(o: DataFrame, min_aln: int = 0, max_cov: int = 200) -> DataFrame:
    """The most frequent coverage of a read, the smaller one on a tie: one row."""
    h = read_coverage(o, min_aln).where(F.col("cov") < max_cov).groupBy("cov").agg(F.count(F.lit(1)).alias("n"))
    return h.orderBy(F.desc("n"), "cov").limit(1).select("cov")


def coverage_events(o: DataFrame) -> DataFrame:
    gain = o.select("aread", "ovl_id", F.col("abpos").alias("pos"), F.lit(1).alias("delta"))
    return gain.unionByName(o.select("aread", "ovl_id", (F.col("aepos") - 1).alias("pos"), F.lit(-1).alias("delta")))


def coverage_regions(o: DataFrame, cov: DataFrame, high: float = 2.0, low: float = 1.7, gap: int | None = None) -> DataFrame:
    """Regions covered more than ``high`` times the expected coverage, until it falls below ``low`` times."""
    ev = coverage_events(o.where("aread <> bread")).crossJoin(F.broadcast(cov))  # one row
    found = sweep(ev, F.floor(F.col("cov") * high), F.floor(F.col("cov") * low))
    return found if gap is None else merge_intervals(found, gap, by=("rid",))


def local_breaks(o: DataFrame, trim: DataFrame, enter: int = 5, leave: int = 3) -> DataFrame:
    """Regions where more than ``enter`` overlaps end inside both trimmed reads."""
    e = with_ends(o.where("aread <> bread"), trim)
    inside = e.where("((abpos > atb and bbpos > btb) or (aepos < ate and bepos < bte)) and atb < ate and btb < bte")
    return sweep(coverage_events(inside), F.lit(enter), F.lit(leave))


def tandem_mask(o: DataFrame, min_len: int = 500, fuzz: int = 20) -> DataFrame:
    """Union of the spans of self overlaps that nearly touch themselves."""
    t = o.where((F.col("abpos") - F.col("bepos") <= fuzz) & (F.col("aepos") - F.col("bbpos") > min_len))
    return merge_intervals(t.select(F.lit("tan").alias("track"), F.col("aread").alias("rid"), F.col("bbpos").alias("beg"), F.col("aepos").alias("end_")))


def beside(trace: DataFrame, o: DataFrame, cols: list[str], sums: dict[str, str] | None = None) -> DataFrame:
    """Trace rows (aread, ovl_id, tile, ...) of the overlaps in ``o``, with its ``cols``; and running ``sums`` (name: column) by tile.

    An overlap stands before its segments instead of being joined with them: Spark sends both sides of a join by A-read and overlap even if they lie by
    A-read already, in as many parts, but not a union of them.
    """
    return stacked(o.select("aread", "ovl_id", F.struct(F.lit(True).alias("_is"), *cols).alias("_o")), trace, sums).where("tile is not null and _h._is").select(
        *trace.columns, *(sums or {}), *(F.col("_h")[c].alias(c) for c in cols)
    )


def stacked(heads: DataFrame, trace: DataFrame, sums: dict[str, str] | None) -> DataFrame:
    """Rows of both with ``_h``: what the overlap's row in ``heads`` (aread, ovl_id, _o) holds in ``_o``."""
    # A name of its own: Spark sees that both lie by the same A-reads only if the column comes from the same kind of place.
    heads = heads.select(F.col("aread").alias("_a"), "ovl_id", *(F.lit(None).cast(trace.schema[c].dataType).alias(c) for c in trace.columns if c not in ("aread", "ovl_id")), "_o")
    rows = heads.unionByName(trace.withColumnRenamed("aread", "_a").withColumn("_o", F.lit(None).cast(heads.schema["_o"].dataType)))
    order = Window.partitionBy("_a", "ovl_id").orderBy(F.asc_nulls_first("tile")).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({"_h": F.first("_o").over(order), **{n: F.sum(c).over(order) for n, c in (sums or {}).items()}}).withColumnRenamed("_a", "aread")


def segment_quality(o: DataFrame, trace: DataFrame, reads: DataFrame, segmin: int = 5, segmax: int = 20, twidth: int = 100) -> DataFrame:
    """q of every tile of every read: rounded mean of its lowest segment differences; 0 with fewer than ``segmin``, 1 for a zero sum.

    Only segments that cover their tile count, and values below the tile width; identity overlaps do not.
    """
    full = beside(trace.where(f"diffs < {twidth} and blen = {twidth}").select("aread", "ovl_id", "tile", "diffs"), o.where("aread <> bread"), [])
    low = Window.partitionBy("aread", "tile").orderBy("diffs", "ovl_id")
    some = full.withColumn("_r", F.row_number().over(low)).where(F.col("_r") <= segmax).groupBy("aread", "tile").agg(F.count(F.lit(1)).alias("n"), F.sum("diffs").alias("s"))
    q = F.when(F.col("n") < segmin, 0).when(F.col("s") == 0, 1).otherwise(F.floor((2 * F.col("s") + F.col("n")) / (2 * F.col("n"))))
    # A read's tiles meet it as one array, so that they are not sent either.
    have = some.select("aread", F.struct(F.col("tile").cast("int").alias("tile"), q.alias("q")).alias("x")).groupBy(F.col("aread").alias("rid")).agg(F.collect_list("x").alias("_q"))
    every = F.when(F.col("rlen") > 0, F.sequence(F.lit(0), F.ceil(F.col("rlen") / twidth).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    known = F.filter("_q", lambda x: (x["tile"] >= 0) & (x["tile"] * twidth < F.col("rlen")))
    other = F.transform(F.array_except(every, F.transform(known, lambda x: x["tile"])), lambda t: F.struct(t.alias("tile"), F.lit(0).cast("long").alias("q")))
    plain = F.transform(every, lambda t: F.struct(t.alias("tile"), F.lit(0).cast("long").alias("q")))
    return reads.join(have, "rid", "left").select("rid", F.inline(F.coalesce(F.concat(known, other), plain)))


def quality_trim(tile_q: DataFrame, reads: DataFrame, d: int = 25, min_len: int = 1000, run: int = 6, twidth: int = 100) -> DataFrame:
    """tb, te from the first to the last run of ``run`` good tiles (0 < q < d); (0, 0) if shorter than ``min_len`` or without one."""
    good = tile_q.where((F.col("q") > 0) & (F.col("q") < d))
    w = Window.partitionBy("rid").orderBy("tile")
    runs = good.withColumn("_g", F.col("tile") - F.row_number().over(w)).groupBy("rid", "_g").agg(F.min("tile").alias("a"), F.max("tile").alias("b")).where(F.col("b") - F.col("a") + 1 >= run)
    ends = runs.groupBy("rid").agg((F.min("a") * twidth).alias("tb"), ((F.max("b") + 1) * twidth).alias("te"))
    j = reads.select("rid", "rlen").join(ends, "rid", "left").withColumn("te", F.least("te", "rlen"))
    ok = F.coalesce(F.col("te") - F.col("tb") >= min_len, F.lit(False))
    return j.select("rid", F.when(ok, F.col("tb")).otherwise(0).alias("tb"), F.when(ok, F.col("te")).otherwise(0).alias("te"))


def rerun_trim(o: DataFrame, trim: DataFrame, tile_q: DataFrame, reads: DataFrame, d: int = 25, min_len: int = 1000, run: int = 6, twidth: int = 100) -> DataFrame:
    """Trims after a look at the piles: where live overlaps with other reads don't reach a trim's ends, the quality trim runs again inside what they cover.

    The first base covered moves on by a tile less one base. Without such overlaps the trim is (0, 0); reads without a pile keep theirs.
    """
    own = flagged(o)
    other = ~has(F.col("flags"), "DISCARD") & (F.col("aread") != F.col("bread"))
    pile = own.groupBy(F.col("aread").alias("rid")).agg(F.min(F.when(other, F.col("abpos"))).alias("_b"), F.max(F.when(other, F.col("aepos"))).alias("_e"))
    j = trim.select("rid", "tb", "te").join(pile.withColumn("_pile", F.lit(True)), "rid", "left")
    j = j.withColumn("_redo", F.coalesce(F.col("_pile") & (F.col("_b").isNull() | (F.col("tb") < F.col("_b")) | (F.col("te") > F.col("_e"))), F.lit(False)))
    inner = j.where("_redo").select("rid", F.floor((F.col("_b") + twidth - 1) / twidth).alias("_from"), F.floor(F.col("_e") / twidth).alias("_to"))
    tiles = tile_q.join(inner, "rid").where("tile >= _from and tile < _to").select("rid", "tile", "q")
    new = quality_trim(tiles, reads, d, min_len, run, twidth).toDF("rid", "_tb", "_te")
    pick = lambda c: F.when(F.col("_redo"), F.coalesce(f"_{c}", F.lit(0))).otherwise(F.col(c)).alias(c)
    return j.join(new, "rid", "left").select("rid", pick("tb"), pick("te"))


def update_trim(o: DataFrame, trim: DataFrame) -> DataFrame:
    """Trims tightened to what live overlaps with other reads cover."""
    ends = purge(flagged(o)).where("aread <> bread").groupBy("aread").agg(F.min("abpos").alias("_b"), F.max("aepos").alias("_e")).withColumnRenamed("aread", "rid")
    j = trim.join(ends, "rid", "left").withColumn("_nb", F.greatest("tb", "_b")).withColumn("_ne", F.least("te", "_e"))
    ok = F.coalesce(F.col("_b").isNotNull() & (F.col("_nb") < F.col("_ne")), F.lit(False))
    return j.select("rid", F.when(ok, F.col("_nb")).otherwise(0).alias("tb"), F.when(ok, F.col("_ne")).otherwise(0).alias("te"))


def tip_coverage(o: DataFrame, trim: DataFrame, z: int = 2, uncovered: int = 500) -> DataFrame:
    """A-reads with too few overlaps at an end, or with too many bases that nothing covers."""
    e = with_ends(o.where("aread <> bread"), trim).where("atb < ate")
    n = e.groupBy("aread").agg(F.count_if(F.col("abpos") <= F.col("atb")).alias("enter_"), F.count_if(F.col("aepos") >= F.col("ate")).alias("leave_"), F.first("atb").alias("atb"), F.first("ate").alias("ate"))
    cov = merge_intervals(e.select(F.col("aread").alias("rid"), F.greatest("abpos", "atb").alias("beg"), F.least("aepos", "ate").alias("end_")).where("beg < end_"), by=("rid",)).groupBy("rid").agg(F.sum(F.col("end_") - F.col("beg")).alias("active"))
    j = n.join(cov.withColumnRenamed("rid", "aread"), "aread", "left").withColumn("open_", F.col("ate") - F.col("atb") - F.coalesce("active", F.lit(0)))
    return j.where((F.col("enter_") <= z) | (F.col("leave_") <= z) | (F.col("open_") > uncovered)).select(F.col("aread").alias("rid"), "enter_", "leave_", "open_")


def pair_self_join(o: DataFrame) -> DataFrame:
    """Every two overlaps of one (A, B, strand), as x_ and y_."""
    cols = ["ovl_id", "abpos", "aepos", "bbpos", "bepos"]
    side = lambda p: o.select("aread", "bread", "comp", *(F.col(c).alias(f"{p}_{c}") for c in cols))
    return side("x").join(side("y"), ["aread", "bread", "comp"]).where("x_ovl_id <> y_ovl_id")


def drop_contained(o: DataFrame) -> DataFrame:
    """CONT where an earlier overlap of the same pair and strand holds this one on both reads; in identity pairs only exact repeats."""
    holds = "x_abpos <= y_abpos and x_aepos >= y_aepos and x_bbpos <= y_bbpos and x_bepos >= y_bepos"
    equal = "x_abpos = y_abpos and x_aepos = y_aepos and x_bbpos = y_bbpos and x_bepos = y_bepos"
    earlier = "struct(x_abpos, x_aepos, x_bbpos, x_bepos, x_ovl_id) < struct(y_abpos, y_aepos, y_bbpos, y_bepos, y_ovl_id)"
    gone = pair_self_join(purge(flagged(o))).where(f"{holds} and {earlier} and (aread <> bread or ({equal}))").select(F.col("y_ovl_id").alias("ovl_id")).distinct().withColumn("_c", F.lit(True))
    return discard(flagged(o).join(gone, "ovl_id", "left"), "CONT", F.coalesce("_c", F.lit(False))).drop("_c")


def drop_multimappers(o: DataFrame) -> DataFrame:
    """Pairs in which one live overlap holds another on A or on B; all their overlaps are discarded."""
    live = purge(flagged(o))

    def held(beg: str, end: str) -> Column:
        # In this order whatever holds a row stands before it.
        w = Window.partitionBy("aread", "bread").orderBy(beg, F.desc(end), "ovl_id")
        return F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)) >= F.col(end)

    marked = live.select("aread", "bread", held("abpos", "aepos").alias("_a"), held("bbpos", "bepos").alias("_b"))
    bad = marked.where("_a or _b").select("aread", "bread").distinct().withColumn("_m", F.lit(True))
    return flagged(o).join(bad, ["aread", "bread"], "left").withColumn("flags", set_flag(F.col("flags"), "DISCARD", F.coalesce("_m", F.lit(False)))).drop("_m")


def prefer_proper(o: DataFrame, trim: DataFrame, fuzz: int = 0) -> DataFrame:
    """Of a pair with exactly one end-to-end overlap and others, the others are discarded."""
    e = with_ends(flagged(o), trim)
    proper = ((F.col("abpos") <= F.col("atb") + fuzz) | (F.col("bbpos") <= F.col("btb") + fuzz)) & ((F.col("aepos") >= F.col("ate") - fuzz) | (F.col("bepos") >= F.col("bte") - fuzz))
    w = Window.partitionBy("aread", "bread")
    e = e.withColumn("_p", proper.cast("int")).withColumn("_n", F.sum("_p").over(w)).withColumn("_k", F.count(F.lit(1)).over(w))
    return e.withColumn("flags", set_flag(F.col("flags"), "DISCARD", (F.col("_n") == 1) & (F.col("_k") > 1) & (F.col("_p") == 0))).drop("_p", "_n", "_k", "atb", "ate", "btb", "bte")


def fully_discarded(o: DataFrame, trim: DataFrame, z: int = 20000) -> DataFrame:
    """A-reads of more than ``z`` trimmed bases without a live overlap."""
    dead = flagged(o).groupBy("aread").agg(F.bool_and(has(F.col("flags"), "DISCARD")).alias("_d")).where("_d")
    return dead.join(trim.withColumnRenamed("rid", "aread"), "aread").where(F.col("te") - F.col("tb") > z).select(F.col("aread").alias("rid"))


def chain_flags(o: DataFrame) -> DataFrame:
    """start, next or gone: the first live overlap of a pair starts its chain."""
    w = Window.partitionBy("aread", "bread").orderBy(has(F.col("flags"), "DISCARD"), *ORDER[2:], "ovl_id")
    r = F.row_number().over(w)
    role = F.when(has(F.col("flags"), "DISCARD"), "gone").when(r == 1, "start").otherwise("next")
    return flagged(o).withColumn("role", role)


def crossings(spots: DataFrame, spans: DataFrame) -> DataFrame:
    """(aread, pos, n): how many spans (aread, beg, end_), both ends included, hold each spot (aread, pos); by bins, so a deep pile is spread."""
    at = spots.select("aread", "pos", (F.col("pos") + 1).alias("_p"))
    held = interval_join(at, spans.where("beg <= end_").withColumn("end_", F.col("end_") + 1), "aread", ("pos", "_p"), ("beg", "end_"))
    n = held.groupBy("aread", "pos").agg(F.count(F.lit(1)).alias("n"))
    return spots.join(n, ["aread", "pos"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def find_gaps(o: DataFrame, trim: DataFrame, min_spanners: int = 2, step: int = 1000, anchor: int = 250) -> DataFrame:
    """A-reads with a window of their trimmed part that fewer than ``min_spanners`` B-reads span by ``anchor`` on both sides."""
    e = o.where("aread <> bread").groupBy("aread", "bread").agg((F.min("abpos") + anchor).alias("beg"), (F.max("aepos") - anchor).alias("end_"))
    spots = trim.where(F.col("te") - F.col("tb") > 2 * step).select(F.col("rid").alias("aread"), F.explode(F.expr(f"sequence(tb + {step}, te - {step}, {step})")).alias("pos"))
    n = crossings(spots, e.select("aread", "beg", "end_"))
    return n.where(F.col("n") < min_spanners).groupBy("aread").agg(F.count(F.lit(1)).alias("gaps"), F.min("pos").alias("first_gap"))


def drop_chimeras(o: DataFrame, trim: DataFrame, c: int = 2, a: int = 200) -> DataFrame:
    """A-reads with an overlap end inside the covered span that fewer than ``c`` overlaps cross with ``a`` bases on both sides."""
    e = o.where("aread <> bread").join(trim.where("tb < te").select(F.col("rid").alias("aread")), "aread", "left_semi")
    span = e.groupBy("aread").agg(F.min("abpos").alias("_l"), F.max("aepos").alias("_r"))
    ends = e.select("aread", F.explode(F.array("abpos", "aepos")).alias("pos")).distinct().join(span, "aread")
    ends = ends.where((F.col("pos") > F.col("_l") + a) & (F.col("pos") < F.col("_r") - a)).select("aread", "pos")
    cross = crossings(ends, e.select("aread", (F.col("abpos") + a).alias("beg"), (F.col("aepos") - a).alias("end_")))
    return cross.groupBy("aread").agg(F.min("n").alias("weakest")).where(F.col("weakest") < c)


def split_overlaps(o: DataFrame, n: int) -> DataFrame:
    """``part`` of each row: n nearly even parts that never split a pile, in the order of A-reads."""
    piles = sums_before(o.groupBy("aread").agg(F.count(F.lit(1)).alias("_c")), "aread", {"_before": F.col("_c")})
    piles = piles.crossJoin(F.broadcast(o.agg(F.count(F.lit(1)).alias("_all"))))  # one row
    return o.join(piles.select("aread", F.floor(F.col("_before") * n / F.col("_all")).alias("part")), "aread")


def union_overlaps(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return sort_overlaps(out)


def pile_apply(o: DataFrame, fn, schema: str, split_b: bool = False, live_only: bool = False) -> DataFrame:
    """A user's function over each pile (A) or pair (A, B) as a pandas frame."""
    o = purge(flagged(o)) if live_only else o
    return o.groupBy("aread", *(["bread"] if split_b else [])).applyInPandas(fn, schema)
