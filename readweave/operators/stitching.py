"""Overlaps that continue each other, ends of overlaps that hold nothing but differences, reads that turn back on themselves."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readweave.functions.columns import FLAG_BITS, bit, common, set_flag

from .intervals import interval_join
from .overlaps import flagged

#: Overlaps with one of these flags neither start nor continue a stitch.
SETTLED = ("CONT", "STITCH", "GAP", "TRIM")
KEY = ["aread", "bread", "comp"]


def trim_indel_ends(o: DataFrame, trace: DataFrame, twidth: int = 100) -> DataFrame:
    """Overlaps without a first or last segment that is all differences, or that covers nothing of B.

    A moves to the next tile boundary, B by the segment's differences. ``cut_first`` and ``cut_last`` say which segment went. Overlaps
    of one segment stay as they are.
    """
    seg = F.struct("diffs", "blen")
    ends = trace.groupBy("ovl_id").agg(F.min_by(seg, "seg").alias("_f"), F.max_by(seg, "seg").alias("_l"), F.count(F.lit(1)).alias("_n"))
    c = F.col
    down = F.floor(c("abpos") / twidth) * twidth
    head = F.when(c("abpos") == 0, 0).otherwise(F.ceil(c("abpos") / twidth) * twidth - c("abpos"))
    tail = c("aepos") % twidth
    first = ((c("_f.diffs") == c("_f.blen")) & (c("_f.diffs") == head)) | ((c("_f.diffs") > 0) & (c("_f.blen") == 0))
    last = ((c("_l.diffs") == c("_l.blen")) & (c("_l.diffs") == tail)) | ((c("_l.diffs") > 2) & (c("_l.blen") == 0))
    j = o.join(ends, "ovl_id", "left")
    for name, rule in (("cut_first", first), ("cut_last", last)):
        j = j.withColumn(name, F.coalesce((c("_n") > 1) & rule, F.lit(False)))
    j = j.withColumn("bbpos", F.when(c("cut_first"), c("bbpos") + c("_f.diffs")).otherwise(c("bbpos")))
    j = j.withColumn("bepos", F.when(c("cut_last"), c("bepos") - c("_l.diffs")).otherwise(c("bepos")))
    j = j.withColumn("aepos", F.when(c("cut_last"), c("aepos") - tail).otherwise(c("aepos")))
    return j.withColumn("abpos", F.when(c("cut_first"), down + twidth).otherwise(c("abpos"))).drop("_f", "_l", "_n")


def follow(rows: pd.DataFrame, starts: np.ndarray, fuzz: int, aggressive: bool) -> pd.DataFrame:
    """Stitches within groups of sorted rows that begin at ``starts``: in their order, each row takes the longest follower until none is left."""
    ab, ae, bb, be, diffs = (rows[n].to_numpy() for n in ("abpos", "aepos", "bbpos", "bepos", "diffs"))
    end, bend, total, gone, grown = ae.copy(), be.copy(), diffs.copy(), np.zeros(len(rows), bool), np.zeros(len(rows), bool)
    for s, e in zip(starts, [*starts[1:], len(rows)], strict=True):
        here = ab[s:e]
        for i in range(s, e):
            while not gone[i]:
                near = np.arange(max(i + 1, s + np.searchsorted(here, end[i] - fuzz, "right")), s + np.searchsorted(here, end[i] + fuzz, "left"))
                da, db = np.abs(end[i] - ab[near]), np.abs(bend[i] - bb[near])
                near = near[~gone[near] & (db < fuzz) & (aggressive | (np.abs(da - db) < 40))]
                if not len(near):
                    break
                k = near[np.argmax(ae[near] - ab[near])]
                end[i], bend[i], grown[i], gone[k] = ae[k], be[k], True, True
                total[i] += diffs[k]
    return pd.DataFrame({"ovl_id": rows["ovl_id"].to_numpy(), "_e": end, "_be": bend, "_d": total, "_gone": gone, "_grown": grown})


def stitch(o: DataFrame, fuzz: int = 40, aggressive: bool = False) -> DataFrame:
    """Joins overlaps of one pair and strand where one begins within ``fuzz`` of the other's end on both reads.

    Without ``aggressive`` the distances on both reads differ by less than 40. The earlier row grows, losing DISCARD and LOCAL; the followers
    get DISCARD and STITCH. Rows that meet no other row's end, nearly all, stay out of the grouped step: an equi-join on bins of the position
    finds the rest.
    """
    o = flagged(o)
    mask = sum(1 << FLAG_BITS[n] for n in SETTLED)
    use = o.where(F.col("flags").bitwiseAND(F.lit(mask)) == 0).select(*KEY, "ovl_id", "abpos", "aepos", "bbpos", "bepos", "diffs")
    tails = use.select(*KEY, F.col("ovl_id").alias("_x"), F.col("aepos").alias("_ae"), F.col("bepos").alias("_be"), F.explode(F.array(*map(F.lit, (-1, 0, 1)))).alias("_s"))
    tails = tails.withColumn("_bin", F.floor(F.col("_ae") / fuzz) + F.col("_s"))
    heads = use.select(*KEY, F.col("ovl_id").alias("_y"), "abpos", "bbpos", F.floor(F.col("abpos") / fuzz).alias("_bin"))
    meet = tails.join(heads, [*KEY, "_bin"]).where(f"_x <> _y and abs(_ae - abpos) < {fuzz} and abs(_be - bbpos) < {fuzz}")
    linked = meet.select(F.explode(F.array("_x", "_y")).alias("ovl_id")).distinct()

    def run(batches):
        rest = None  # the last group of a batch may go on in the next one
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            starts = np.flatnonzero((pdf[KEY] != pdf[KEY].shift()).any(axis=1).to_numpy())
            if len(starts) > 1:
                yield follow(pdf.iloc[: starts[-1]], starts[:-1], fuzz, aggressive)
            rest = pdf.iloc[starts[-1] :] if len(starts) else None
        if rest is not None:
            yield follow(rest, np.array([0]), fuzz, aggressive)

    schema = "ovl_id long, _e long, _be long, _d long, _gone boolean, _grown boolean"
    dealt = use.join(linked, "ovl_id", "left_semi").repartition(*KEY).sortWithinPartitions(*KEY, "abpos", "aepos", "bbpos", "bepos", "ovl_id")
    done = dealt.mapInPandas(run, schema)
    j = o.join(done.where("_gone or _grown"), "ovl_id", "left")
    gone, grown = F.coalesce("_gone", F.lit(False)), F.coalesce("_grown", F.lit(False)) & ~F.coalesce("_gone", F.lit(False))
    for name, new in (("aepos", "_e"), ("bepos", "_be"), ("diffs", "_d")):
        j = j.withColumn(name, F.when(grown, F.col(new)).otherwise(F.col(name)))
    cleared = F.when(grown, F.col("flags").bitwiseAND(F.lit(~(bit("DISCARD") | bit("LOCAL"))))).otherwise(F.col("flags"))
    j = j.withColumn("flags", set_flag(set_flag(cleared, "DISCARD", gone), "STITCH", gone))
    return j.select(*o.columns)


def turn_events(o: DataFrame, trace: DataFrame, trim: DataFrame, twidth: int = 100) -> DataFrame:
    """Places (aread, kind, ord, at, lo, hi) where a read's complement overlap with itself crosses the diagonal, and the part (clo, chi) to cut.

    Kind 0: a segment of one overlap, but for its last two; kind 1: the gap between two overlaps that follow each other, cut at its middle.
    Only parts inside the trim (tb, te) count.
    """
    flip = o.where("aread = bread and comp = 1")
    w = Window.partitionBy("aread").orderBy("abpos", "aepos", "bbpos", "bepos", "ovl_id")
    flip = flip.withColumn("ord", F.row_number().over(w)).withColumn("_next", F.lead(F.struct("abpos", "bbpos")).over(w))
    cross = flip.where(common(F.col("abpos"), F.col("aepos"), F.col("alen") - F.col("bepos"), F.col("alen") - F.col("bbpos")) > 0)
    own = Window.partitionBy("ovl_id")
    s = trace.select("ovl_id", "seg", F.col("blen").alias("_l")).join(cross, "ovl_id")
    s = s.withColumn("_n", F.count(F.lit(1)).over(own)).withColumn("_bb", F.col("bbpos") + F.sum("_l").over(own.orderBy("seg")) - F.col("_l"))
    first = F.floor(F.col("abpos") / twidth)
    s = s.withColumn("lo", F.greatest(F.col("abpos"), (first + F.col("seg")) * twidth)).withColumn("hi", (first + F.col("seg") + 1) * twidth)
    hit = common(F.col("lo"), F.col("hi") + 1, F.col("alen") - F.col("_bb") - F.col("_l"), F.col("alen") - F.col("_bb") - 1) > 0
    lone = s.where(hit & (F.col("seg") <= F.col("_n") - 3)).select("aread", F.lit(0).alias("kind"), "ord", F.col("seg").cast("long").alias("at"), "lo", "hi")
    gap = flip.where("_next is not null").select("aread", "alen", "ord", F.col("aepos").alias("lo"), F.col("_next.abpos").alias("hi"), "_next.bbpos", "bepos")
    gap = gap.where(common(F.col("lo"), F.col("hi"), F.col("alen") - F.col("bbpos"), F.col("alen") - F.col("bepos")) > 0)
    both = lone.unionByName(gap.select("aread", F.lit(1).alias("kind"), "ord", F.lit(0).cast("long").alias("at"), "lo", "hi"))
    cut = lambda c: F.when(F.col("kind") == 1, F.floor((F.col("lo") + F.col("hi")) / 2)).otherwise(F.col(c)).alias(f"c{c}")
    both = both.select("*", cut("lo"), cut("hi"))
    return both.join(trim.select(F.col("rid").alias("aread"), "tb", "te"), "aread").where("tb < clo and chi < te")


def missed_adapters(o: DataFrame, trace: DataFrame, trim: DataFrame, repeats: DataFrame | None = None, span: int = 400, span_repeat: int = 800) -> DataFrame:
    """Trims (rid, tb, te, n) of reads that turn back on themselves: at each place with at most one spanner the shorter side goes.

    A spanner reaches ``span`` bases to both sides or to the trim, ``span_repeat`` where the place has fewer than 100 bases outside
    ``repeats``. Places apply in the order of overlaps and segments, gaps last, each to the trim that the ones before left.
    """
    e = turn_events(o, trace, trim)
    key = ["aread", "kind", "ord", "at"]
    if repeats is None:
        e = e.withColumn("_rep", F.lit(0))
    else:
        iv = repeats.select(F.col("rid").alias("aread"), "beg", "end_")
        inside = interval_join(e.select(*key, "lo", "hi"), iv, "aread", ("lo", "hi"), ("beg", "end_")).groupBy(*key).agg(F.sum("bp").alias("_rep"))
        e = e.join(inside, key, "left").withColumn("_rep", F.coalesce("_rep", F.lit(0)))
    side = F.when(F.col("hi") - F.col("lo") - F.col("_rep") < 100, span_repeat).otherwise(span)
    e = e.withColumn("_from", F.greatest(F.col("tb"), F.col("lo") - side)).withColumn("_to", F.least(F.col("te"), F.col("hi") + side))
    # A spanner holds the first base of the cut, as that lies inside the trim.
    e = e.withColumn("_p", F.col("clo") + 1)
    met = interval_join(e.select(*key, "clo", "_p", "_from", "_to"), o.select("aread", "abpos", "aepos"), "aread", ("clo", "_p"), ("abpos", "aepos"))
    many = met.where("abpos <= _from and aepos >= _to").groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    whole = lambda c, to: F.col(c).cast("long").alias(to)
    kept = e.join(many, key, "left_anti").select(*key, whole("clo", "lo"), whole("chi", "hi"), F.struct(whole("tb", "tb"), whole("te", "te")).alias("_t"))
    places = kept.groupBy("aread").agg(F.sort_array(F.collect_list(F.struct("kind", "ord", "at", "lo", "hi"))).alias("_e"), F.first("_t").alias("_t"))

    def cut(t, x):
        fits, left = (t["tb"] < x["lo"]) & (x["hi"] < t["te"]), x["lo"] - t["tb"] < t["te"] - x["hi"]
        return F.struct(F.when(fits & left, x["hi"]).otherwise(t["tb"]).alias("tb"), F.when(fits & ~left, x["lo"]).otherwise(t["te"]).alias("te"))

    return places.select(F.col("aread").alias("rid"), F.aggregate("_e", F.col("_t"), cut).alias("_r"), F.size("_e").alias("n")).select("rid", "_r.tb", "_r.te", "n")
