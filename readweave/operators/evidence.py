"""Evidence about reads: repeat edges, gaps in piles, worst alignments, quality histograms, k-mer windows, shared reads."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readweave.functions.lineage import settled

from .intervals import interval_join, merge_intervals, unique_intervals
from .letters import self_bands
from .overlaps import discard, flagged, purge, with_ends
from .reads import rare_kmers


def extend_edges(regions: DataFrame, o: DataFrame, reads: DataFrame, near: int = 1000, fuzz: int = 200, more_than: int = 2) -> DataFrame:
    """A region that begins within ``near`` of a read end goes on to that end if overlaps starting there stop at its inner edge."""
    live = o.where("aread <> bread").select(F.col("aread").alias("rid"), "abpos", "aepos", "alen")
    heads = regions.where(F.col("beg") < near).join(live.where("abpos = 0"), "rid").where(F.abs(F.col("aepos") - F.col("end_")) <= fuzz)
    tails = regions.join(live.where("aepos = alen"), "rid").where((F.col("alen") - F.col("end_") < near) & (F.abs(F.col("abpos") - F.col("beg")) <= fuzz))
    many = lambda d, name: d.groupBy("rid", "beg", "end_").agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > more_than)
    j = regions.join(many(heads, "_h"), ["rid", "beg", "end_"], "left").join(many(tails, "_t"), ["rid", "beg", "end_"], "left").join(reads.select("rid", "rlen"), "rid")
    return j.select("rid", F.when(F.col("_h").isNotNull(), 0).otherwise(F.col("beg")).alias("beg"), F.when(F.col("_t").isNotNull(), F.col("rlen")).otherwise(F.col("end_")).alias("end_"))


def pile_gaps(o: DataFrame, mask: DataFrame | None = None, bin_: int = 100, inner: int = 450, at_most: int = 1) -> DataFrame:
    """Runs of bins (aread, beg, end_) between a pile's first and last bin that ``at_most`` overlaps cover; those inside a mask interval don't count.

    Overlaps count from ``inner`` bases inside their ends; of overlaps of one pair that intersect, the longer counts.
    """
    use = purge(flagged(o)).where("aread <> bread").select("ovl_id", "aread", "bread", "abpos", "aepos")
    other = use.select("aread", "bread", *(F.col(c).alias(f"_{c}") for c in ("ovl_id", "abpos", "aepos")))
    beaten = use.join(other, ["aread", "bread"]).where("abpos < _aepos and _abpos < aepos and struct(_aepos - _abpos, -_ovl_id) > struct(aepos - abpos, -ovl_id)").select("ovl_id").distinct()
    thin = use.join(beaten, "ovl_id", "left_anti").select("aread", F.floor((F.col("abpos") + inner) / bin_).alias("b"), F.floor((F.col("aepos") - inner) / bin_).alias("e")).where("b <= e")
    cov = thin.select("aread", F.explode(F.sequence("b", "e")).alias("bin")).groupBy("aread", "bin").agg(F.count(F.lit(1)).alias("n"))
    ends = thin.groupBy("aread").agg(F.min("b").alias("b"), F.max("e").alias("e"))
    low = ends.select("aread", F.explode(F.sequence("b", "e")).alias("bin")).join(cov, ["aread", "bin"], "left").where(F.coalesce("n", F.lit(0)) <= at_most)
    w = Window.partitionBy("aread").orderBy("bin")
    runs = low.withColumn("_g", F.col("bin") - F.row_number().over(w)).groupBy("aread", "_g").agg((F.min("bin") * bin_).alias("beg"), ((F.max("bin") + 1) * bin_).alias("end_")).drop("_g")
    # Thin coverage at the very ends of the pile is no gap.
    runs = runs.join(ends, "aread").where((F.col("beg") > F.col("b") * bin_) & (F.col("end_") < (F.col("e") + 1) * bin_)).drop("b", "e")
    if mask is not None:
        m = mask.select(F.col("rid").alias("aread"), F.col("beg").alias("mb"), F.col("end_").alias("me"))
        inside = interval_join(runs, m, "aread", ("beg", "end_"), ("mb", "me")).where("mb <= beg and me >= end_").select("aread", "beg", "end_").distinct()
        runs = runs.join(inside, ["aread", "beg", "end_"], "left_anti")
    return runs


def detect_gaps(o: DataFrame, mask: DataFrame | None = None) -> DataFrame:
    """GAP for overlaps beyond a gap of their pile, seen from its longest overlap.

    At each gap the side without the longest overlap goes, so the longest stays throughout and only the nearest gap on each side of its
    middle matters; no order of gaps has to be kept.
    """
    o = flagged(o)
    live = purge(o).where("aread <> bread")
    best = live.groupBy("aread").agg(F.max_by(F.struct("abpos", "aepos"), F.struct(F.col("aepos") - F.col("abpos"), -F.col("ovl_id"))).alias("_l"))
    middle = F.floor((F.col("_l.abpos") + F.col("_l.aepos")) / 2)
    side = pile_gaps(o, mask).join(best, "aread").withColumn("_m", middle).groupBy("aread").agg(F.max(F.when(F.col("beg") <= F.col("_m"), F.col("beg"))).alias("_left"), F.min(F.when(F.col("beg") > F.col("_m"), F.col("end_"))).alias("_right"))
    j = o.join(side, "aread", "left")
    far = F.coalesce((F.col("abpos") + F.col("aepos")) / 2 < F.col("_left"), F.lit(False)) | F.coalesce((F.col("abpos") + F.col("aepos")) / 2 > F.col("_right"), F.lit(False))
    return discard(j, "GAP", far & (F.col("aread") != F.col("bread"))).drop("_left", "_right")


def drop_worst(o: DataFrame, trim: DataFrame, z_pct: int = 10, max_div: float = 0.05, z: int = 3) -> DataFrame:
    """DIFF for the most divergent overlaps of a pile, up to ``z_pct`` percent of its aligned bases.

    It ends at the first overlap below ``max_div``, or when fewer than min(3, z) would enter or leave the trimmed read.
    """
    e = with_ends(flagged(o), trim)
    live = purge(e).where("aread <> bread").withColumn("_span", F.col("aepos") - F.col("abpos"))
    pile = Window.partitionBy("aread")
    rank = pile.orderBy(F.desc("_div"), "ovl_id").rowsBetween(Window.unboundedPreceding, 0)
    enter, leave = (F.col("abpos") <= F.col("atb")).cast("int"), (F.col("aepos") >= F.col("ate")).cast("int")
    live = live.withColumn("_div", F.floor(1_000_000 * F.col("diffs") / F.col("_span"))).withColumn("_in", enter).withColumn("_out", leave)
    least = min(3, z)
    ok = (
        (100 * F.sum("_span").over(rank) <= z_pct * F.sum("_span").over(pile))
        & (F.col("_div") >= int(max_div * 1_000_000))
        & ((F.sum("_in").over(pile) - F.sum("_in").over(rank) >= least) | (F.col("_in") == 0))
        & ((F.sum("_out").over(pile) - F.sum("_out").over(rank) >= least) | (F.col("_out") == 0))
    )
    worst = live.withColumn("_ok", ok.cast("int")).withColumn("_ok", F.min("_ok").over(rank)).where("_ok = 1").select("ovl_id", F.lit(True).alias("_w"))
    return discard(e.join(worst, "ovl_id", "left"), "DIFF", F.coalesce("_w", F.lit(False))).drop("_w", "atb", "ate", "btb", "bte")


def q_histogram(tile_q: DataFrame, trim: DataFrame, reads: DataFrame, iv: DataFrame, twidth: int = 100, min_trim: int = 1000) -> DataFrame:
    """Tiles by q: complete tiles in unique stretches of more than three tiles, a tile or more away from repeats; q is at most 99."""
    ok = trim.where(F.col("te") - F.col("tb") >= min_trim)
    u = unique_intervals(iv, reads, ok).where(F.col("end_") - F.col("beg") > 3 * twidth)
    tiles = u.select("rid", F.ceil((F.col("beg") + twidth) / twidth).alias("a"), (F.floor((F.col("end_") - twidth) / twidth) - 1).alias("b")).where("a <= b").select("rid", F.explode(F.sequence("a", "b")).alias("tile"))
    return tile_q.join(tiles, ["rid", "tile"]).groupBy(F.least("q", F.lit(99)).alias("q")).agg(F.count(F.lit(1)).alias("n"))


def fit_normal(df: DataFrame, col: str) -> DataFrame:
    """mu and sigma (population): one row."""
    return df.agg(F.avg(col).alias("mu"), F.stddev_pop(col).alias("sigma"))


def fit_lognormal(df: DataFrame, col: str) -> DataFrame:
    """mu and sigma of the logarithms of the positive values: one row."""
    return fit_normal(df.where(F.col(col) > 0).select(F.log(col).alias("v")), "v")


def repeat_bases(contigs: DataFrame, iv: DataFrame) -> DataFrame:
    """Repeat bases of each contig (cid, len) and their percent; of several tracks the one with most counts."""
    whole = contigs.select(F.col("cid").alias("rid"), F.lit(0).alias("cb"), F.col("len").alias("ce"))
    per = interval_join(whole, merge_intervals(iv), "rid", ("cb", "ce"), ("beg", "end_")).groupBy("rid", "track").agg(F.sum("bp").alias("bp"))
    most = per.groupBy(F.col("rid").alias("cid")).agg(F.max("bp").alias("bp"))
    return contigs.join(most, "cid", "left").select("cid", "len", F.coalesce("bp", F.lit(0)).alias("bp"), F.when(F.col("len") > 0, F.floor(100 * F.coalesce("bp", F.lit(0)) / F.col("len"))).otherwise(0).alias("pct"))


def kmer_cutoffs(histogram: DataFrame, top_pct: int = 1) -> DataFrame:
    """One row: the least count of the ``top_pct`` percent of distinct k-mers with most occurrences, and the first count at which the histogram rises again.

    The histogram (n, kmers) has at most 255 rows.
    """
    w = Window.orderBy(F.desc("n"))
    h = histogram.withColumn("_cum", F.sum("kmers").over(w)).withColumn("_all", F.sum("kmers").over(Window.partitionBy()))
    up = Window.orderBy("n")
    h = h.withColumn("_rise", F.col("kmers") > F.lag("kmers").over(up)).withColumn("_prev", F.lag("n").over(up))
    return h.agg(
        F.coalesce(F.min(F.when(100 * F.col("_cum") <= top_pct * F.col("_all"), F.col("n"))), F.max("n") + 1).alias("repeat_cut"),
        F.coalesce(F.min(F.when(F.col("_rise"), F.col("_prev"))), F.lit(1)).alias("noise_cut"),
    )


def conserved(k: int, error: float) -> float:
    """The chance that a k-mer comes through sequencing with ``error`` (a share of bases) as it is."""
    right = 1 - error
    return right ** (k + 1) + (right ** (k - 1) - right ** (2 * k - 1)) / k


def kmer_model(histogram: DataFrame, k: int, error: float, coverage: float, genome_mb: float, window: int, top_pct: float = 1.0) -> DataFrame:
    """One row: over and noise (counts), and what share of a genome's k-mers lie beyond each, by position (expected) and by window (load).

    over: all counts above it, taken from the top, are the first to hold ``top_pct`` percent of the distinct k-mers. noise: the count that a k-mer of the
    genome is expected to keep at ``coverage`` and ``error`` percent. The histogram (n, kmers) has at most 255 rows.
    """
    c = F.col
    places = genome_mb * 1e6 * coverage * 0.5
    noise = math.floor(max(1.0, genome_mb * 1e6 * 0.5 / 4**k) * coverage * conserved(k, error / 100))
    w = Window.orderBy(F.desc("n"))
    h = histogram.withColumn("_all", F.sum("kmers").over(Window.partitionBy()))
    h = h.withColumn("_before", F.coalesce(F.sum("kmers").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    top = 100.0 * c("_before") < top_pct * c("_all")
    out = h.agg(
        F.coalesce(F.min(F.when(top, c("n"))) - 1, F.lit(0)).alias("over"), (F.coalesce(F.sum(F.when(top, c("n") * c("kmers"))), F.lit(0)) / F.lit(places)).alias("over_expected"),
        F.lit(noise).alias("noise"), (F.coalesce(F.sum(F.when(c("n") <= noise, c("n") * c("kmers"))), F.lit(0)) / F.lit(places)).alias("noise_expected"),
    )
    return out.withColumn("over_load", c("over_expected") * (window - k + 1)).withColumn("noise_load", c("noise_expected") * (window - k + 1))


def cluster_borders(events: DataFrame, density: float, min_events: int, max_dist: int) -> DataFrame:
    """rid, beg, end_, n: events (rid, pos) in groups that are dense (more than ``density`` a base, or all at one place) and shorter than ``max_dist``.

    What is not is cut at its widest gap (the first of equal ones), again and again; groups of fewer than ``min_events`` go. All groups of all
    reads are cut in the same round, and lineage is cut with them.
    """
    c = F.col
    number = F.row_number().over(Window.partitionBy("rid").orderBy("pos"))
    rows = settled(events.select("rid", "pos", number.alias("k"), F.lit(1).alias("g")))
    out = None
    while True:
        size = c("_hi") - c("_lo")
        s = rows.groupBy("rid", "g").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("_lo"), F.max("pos").alias("_hi")).where(c("n") >= min_events)
        dense = ((size == 0) | (c("n") > density * size)) & (size < max_dist)
        s = settled(s.withColumn("_ok", dense))
        done = s.where("_ok").select("rid", c("_lo").alias("beg"), c("_hi").alias("end_"), "n")
        out = done if out is None else out.unionByName(done)
        w = Window.partitionBy("rid", "g").orderBy("k")
        left = rows.join(s.where("not _ok").select("rid", "g"), ["rid", "g"]).withColumn("_gap", c("pos") - F.lag("pos").over(w))
        cut = left.where("_gap is not null").groupBy("rid", "g").agg(F.max_by("k", F.struct("_gap", -c("k"))).alias("_at"))
        rows = settled(left.join(cut, ["rid", "g"]).select("rid", "pos", "k", F.when(c("k") >= c("_at"), c("_at")).otherwise(c("g")).alias("g")))
        if rows.isEmpty():
            return out


def kmer_windows(reads: DataFrame, k: int, noise: int, repeat: int, wnd: int = 500, gap: int = 0) -> DataFrame:
    """noise and repeat tracks: windows of k-mer starts in which more than half occur at most ``noise`` or at least ``repeat`` times."""
    least = max(noise + 1, repeat)
    # All k-mers of a window are counted by its length; places of rare ones are all that is counted one by one.
    starts = F.length("seq") - k + 1
    every = reads.where(F.length("seq") >= k).select("rid", starts.alias("_s"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((starts - 1) / wnd))).alias("_w"))
    every = every.groupBy("rid", "_w").agg(F.sum(F.least(F.lit(wnd), F.col("_s") - F.col("_w") * wnd)).alias("_n"))
    rare = rare_kmers(reads, k, least).groupBy("rid", F.floor((F.col("pos") - 1) / wnd).alias("_w")).agg(F.count_if(F.col("n") <= noise).alias("_lo"), F.count_if(F.col("n") < repeat).alias("_few"))
    win = every.join(rare.withColumnsRenamed({"rid": "_rid", "_w": "_rw"}), F.col("rid").eqNullSafe(F.col("_rid")) & (F.col("_w") == F.col("_rw")), "left")
    few = F.coalesce("_few", F.lit(0))
    track = F.when(2 * F.col("_lo") > F.col("_n"), "noise").when(2 * (F.col("_n") - few) > F.col("_n"), "repeat")
    rows = win.withColumn("track", track).where("track is not null").select("track", "rid", (F.col("_w") * wnd).alias("beg"), (F.col("_w") * wnd + F.col("_n")).alias("end_"))
    return merge_intervals(rows, gap)


def self_seed_hits(reads: DataFrame, k: int = 12, w: int = 4, h: int = 35) -> DataFrame:
    """Diagonal bands (rid, band, score, total, amin, amax) of k-mers that repeat their last occurrence in the same read.

    A seed adds min(k, distance to the last seed of its band); a band is a hit if it and the next one reach ``h``. A read goes to its task as
    text; no row of a k-mer is sent.
    """
    texts = reads.where(F.length("seq") >= k).groupBy("rid").agg(F.collect_list("seq").alias("_s"))
    kind = reads.schema["rid"].dataType.simpleString()
    return texts.mapInArrow(self_bands(k, w, h), f"rid {kind}, band long, score long, amin long, amax long, total long")


#: Contig reads in one part: what their arrays unfold to is sorted in a task's memory.
PART = 100_000


def partners(r: DataFrame, order: list[str], carry: list[str], many: int) -> DataFrame:
    """Rows of ``r`` (cid, rid, ...), ``many`` of them, by contig, with ``after``: arrays of ``carry`` of the contigs later in ``order`` that hold the read.

    A read's contigs meet in one array; what is sent on is a row for each contig and read, not for each pair of contigs.
    """
    kept = [*order, *(c for c in r.columns if c != "rid" and c not in order)]
    met = r.where("rid is not null").groupBy("rid").agg(F.array_sort(F.collect_list(F.struct(*kept))).alias("_all")).select("rid", "_all", F.posexplode("_all").alias("_i", "_me"))
    rest = F.slice("_all", F.col("_i") + 2, F.size("_all"))
    d = met.select("rid", *(F.col("_me")[c].alias(c) for c in kept), F.struct(*(rest[c].alias(c) for c in carry)).alias("after"))
    usual = int(r.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return d.repartition(max(usual, many // PART), "cid")


def contig_read_intersection(cr: DataFrame, min_pct: int = 1) -> DataFrame:
    """Pairs of contigs that share more than ``min_pct`` percent of the smaller one's reads. cr: (cid, rid)."""
    c = settled(cr.select("cid", "rid").repartition("cid").distinct().withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("cid"))))
    both = F.arrays_zip(F.col("after.cid").alias("c2"), F.col("after.n").alias("n2"))
    pairs = partners(c, ["cid"], ["cid", "n"], c.count()).select(F.col("cid").alias("c1"), F.col("n").alias("n1"), F.explode(both).alias("_b"))
    shared = pairs.select("c1", "n1", "_b.c2", "_b.n2").groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("shared"), F.first("n1").alias("n1"), F.first("n2").alias("n2"))
    return shared.where(100 * F.col("shared") > min_pct * F.least("n1", "n2")).withColumn("alternative", 2 * F.col("shared") > F.least("n1", "n2"))


def shared_ranges(cr: DataFrame, contigs: DataFrame, min_pct: float = 1.0) -> DataFrame:
    """c1, c2, n2, rid, and where the read lies on both (beg1, end1, beg2, end2), for each read that two contigs share.

    c1 is the longer contig (of equal ones that with the smaller cid). Pairs stay that share more than ``min_pct`` percent of c2's reads. cr: (cid,
    rid, beg, end_); a read that lies on a contig several times takes the range from its first to its last base. Rows lie by c1 and are made there.
    """
    r = cr.repartition("cid").groupBy("cid", "rid").agg(F.min("beg").alias("beg"), F.max("end_").alias("end_"))
    r = r.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("cid"))).join(contigs.select("cid", (-F.col("len")).alias("_less")), "cid")
    both = F.arrays_zip(*(F.col(f"after.{c}").alias(n) for c, n in (("cid", "c2"), ("n", "n2"), ("beg", "beg2"), ("end_", "end2"))))
    j = partners(r, ["_less", "cid"], ["cid", "n", "beg", "end_"], cr.count()).select(F.col("cid").alias("c1"), "rid", F.col("beg").alias("beg1"), F.col("end_").alias("end1"), F.explode(both).alias("_b"))
    j = j.select("c1", "_b.c2", "_b.n2", "rid", "beg1", "end1", "_b.beg2", "_b.end2").withColumn("shared", F.count(F.lit(1)).over(Window.partitionBy("c1", "c2")))
    return j.where(100 * F.col("shared") > min_pct * F.col("n2")).select("c1", "c2", "shared", "n2", "rid", "beg1", "end1", "beg2", "end2")


def shared_blocks(ranges: DataFrame, bin_: int = 100) -> DataFrame:
    """c1, c2, shared, n2, cid, beg, end_, depth: stretches of bins, on each of both contigs, where shared reads lie, with their mean number.

    A read fills all bins from that of its first to that of its end. end_ is the last base of the last bin.
    """
    side = lambda k: F.struct(F.col(f"c{k}").alias("cid"), F.floor(F.col(f"beg{k}") / bin_).alias("b"), (F.floor(F.col(f"end{k}") / bin_) + 1).alias("e"))
    s = ranges.select("c1", "c2", "shared", "n2", F.inline(F.array(side(1), side(2))))
    w = Window.partitionBy("c1", "c2", "cid").orderBy("b", "e")
    before = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    isl = s.withColumn("_n", F.when(F.col("b") <= before, 0).otherwise(1)).withColumn("_g", F.sum("_n").over(w))
    isl = isl.groupBy("c1", "c2", "cid", "_g").agg(F.min("b").alias("b"), F.max("e").alias("e"), F.sum(F.col("e") - F.col("b")).alias("d"), F.first("shared").alias("shared"), F.first("n2").alias("n2"))
    return isl.select("c1", "c2", "shared", "n2", "cid", (F.col("b") * bin_).alias("beg"), (F.col("e") * bin_ - 1).alias("end_"), F.floor(F.col("d") / (F.col("e") - F.col("b"))).alias("depth"))


def read_alternatives(blocks: DataFrame, contigs: DataFrame, read_pct: int = 50, cover_pct: int = 50) -> DataFrame:
    """c1, c2, shared, n2, covered, alternative: c2 is an alternative of c1 if they share more than ``read_pct`` percent of its reads, or blocks cover ``cover_pct`` percent of it.

    Each pair that shares reads has a block on c2, so the blocks are all that is read.
    """
    size = blocks.where(F.col("cid") == F.col("c2")).groupBy("c1", "c2").agg(F.first("shared").alias("shared"), F.first("n2").alias("n2"), F.sum(F.col("end_") - F.col("beg")).alias("covered"))
    j = size.join(contigs.select(F.col("cid").alias("c2"), "len"), "c2")
    alt = (100 * F.col("shared") > read_pct * F.col("n2")) | (100 * F.col("covered") >= cover_pct * F.col("len"))
    return j.select("c1", "c2", "shared", "n2", "covered", alt.alias("alternative"))


def contig_coverage(cr: DataFrame, bin_: int = 500) -> DataFrame:
    """Per contig read (cid, rid, part, abpos, aepos, alen): reads entering at its start, leaving at its end, coverage, and bins without a full spanner."""
    g = cr.groupBy("cid", "rid").agg(F.count_if(F.col("abpos") == 0).alias("entering"), F.count_if(F.col("aepos") == F.col("alen")).alias("leaving"), F.floor(F.sum(F.col("aepos") - F.col("abpos")) / F.first("alen")).alias("cov"), F.first("alen").alias("alen"))
    first, last = F.ceil(F.col("abpos") / bin_), F.floor(F.col("aepos") / bin_) - 1
    full = cr.select("cid", "rid", first.alias("a"), last.alias("b")).where("a <= b").select("cid", "rid", F.explode(F.sequence("a", "b")).alias("bin")).distinct().groupBy("cid", "rid").agg(F.count(F.lit(1)).alias("_full"))
    return g.join(full, ["cid", "rid"], "left").select("cid", "rid", "entering", "leaving", "cov", (F.floor(F.col("alen") / bin_) - F.coalesce("_full", F.lit(0))).alias("open_bins"))
