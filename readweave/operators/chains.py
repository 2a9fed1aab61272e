"""Chains of local overlaps of one pair (A, B), and rules over chains.

A chain is a (aread, bread, chain) group with a rank along A. Groups are as small as the overlaps of two reads.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readweave.functions.columns import bit, forward_b, set_flag

from .intervals import interval_join, merge_intervals
from .overlaps import discard, flagged, purge, with_ends

#: The gap limit grows by the step to the most.
GAP_STEP, GAP_MOST = 2000, 30000


def follower(x: dict[str, np.ndarray], at: int, free: np.ndarray, right: bool) -> int | None:
    """The free overlap that goes on from ``at``: same strand, onward on both reads, not contained, at least half of it beyond; the nearest gap class first, then the longest."""
    i = np.flatnonzero(free)
    a, b = (np.full(len(i), at), i) if right else (i, np.full(len(i), at))
    ok = (x["comp"][a] == x["comp"][b]) & (x["abpos"][a] < x["abpos"][b]) & (x["aepos"][a] < x["aepos"][b]) & (x["bbpos"][a] < x["bbpos"][b]) & (x["bepos"][a] < x["bepos"][b])
    new = x["aepos"][b] - np.maximum(x["abpos"][b], x["aepos"][a]) if right else np.minimum(x["aepos"][a], x["abpos"][b]) - x["abpos"][a]
    length = x["aepos"][i] - x["abpos"][i]
    gap = np.maximum(np.maximum(x["abpos"][b] - x["aepos"][a], x["bbpos"][b] - x["bepos"][a]), 0)
    ok &= (2 * new >= length) & (gap <= GAP_MOST)
    if not ok.any():
        return None
    i, length, gap = i[ok], length[ok], gap[ok]
    return int(i[np.lexsort((x["ovl_id"][i], -length, -(-gap // GAP_STEP)))[0]])


#: What chaining looks at.
PIECE = ("ovl_id", "comp", "abpos", "aepos", "bbpos", "bepos", "unique_bp")


def chain_pair(x: dict[str, np.ndarray]) -> list[tuple[int, int, int]]:
    """ovl_id, chain and rank of each overlap of a pair: from the one with most unique bases (then the longest) to both sides, and again with the rest."""
    seeds = np.lexsort((x["ovl_id"], x["abpos"] - x["aepos"], -x["unique_bp"]))
    free, out, number = np.ones(len(seeds), bool), [], 0
    for seed in seeds:
        if not free[seed]:
            continue
        free[seed] = False
        chain = [seed]
        for right in (True, False):
            while free.any() and (nxt := follower(x, chain[-1] if right else chain[0], free, right)) is not None:
                free[nxt] = False
                chain.insert(len(chain) if right else 0, nxt)
        out += [(int(x["ovl_id"][i]), number, k) for k, i in enumerate(chain)]
        number += 1
    return out


#: Pairs with more overlaps are chained one by one.
WIDE = 64


def followers(x: dict[str, np.ndarray], rows: np.ndarray, at: np.ndarray, free: np.ndarray, right: bool) -> np.ndarray:
    """``follower`` for many pairs at once: arrays of ``x`` and ``free`` have a row for each pair; -1 where none goes on."""
    here, all_ = ({c: (x[c][rows, at][:, None] if one else x[c][rows]) for c in PIECE} for one in (True, False))
    a, b = (here, all_) if right else (all_, here)
    ok = free[rows] & (a["comp"] == b["comp"])
    for c in ("abpos", "aepos", "bbpos", "bepos"):
        ok &= a[c] < b[c]
    new = b["aepos"] - np.maximum(b["abpos"], a["aepos"]) if right else np.minimum(a["aepos"], b["abpos"]) - a["abpos"]
    length = all_["aepos"] - all_["abpos"]
    gap = np.maximum(np.maximum(b["abpos"] - a["aepos"], b["bbpos"] - a["bepos"]), 0)
    ok &= (2 * new >= length) & (gap <= GAP_MOST)
    for key in (-(-gap // GAP_STEP), -length, all_["ovl_id"]):
        key = np.where(ok, key, np.iinfo("i8").max)
        ok &= key == key.min(axis=1, keepdims=True)
    return np.where(ok.any(axis=1), ok.argmax(axis=1), -1)


def chain_many(x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """chain and rank of the overlaps of many pairs with equally many overlaps (a row for each pair), as ``chain_pair`` gives them."""
    many, m = x["ovl_id"].shape
    pair = np.repeat(np.arange(many), m)
    seeds = np.lexsort((x["ovl_id"].ravel(), (x["abpos"] - x["aepos"]).ravel(), -x["unique_bp"].ravel(), pair)).reshape(many, m) % m
    free, number = np.ones((many, m), bool), np.zeros(many, "i8")
    chain, place, left = (np.zeros((many, m), "i8") for _ in range(3))
    for k in range(m):
        rows = np.flatnonzero(free[np.arange(many), seeds[:, k]])
        seed = seeds[rows, k]
        free[rows, seed] = False
        chain[rows, seed] = number[rows]
        for right in (True, False):
            on, at, step = rows, seed, 0
            while len(on):
                nxt = followers(x, on, at, free, right)
                on, at, step = on[nxt >= 0], nxt[nxt >= 0], step + 1
                free[on, at] = False
                chain[on, at] = number[on]
                place[on, at] = step if right else -step
                if not right:
                    left[on, number[on]] = step
        number[rows] += 1
    return chain, place + np.take_along_axis(left, chain, axis=1)


def chain_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The overlaps of rows that hold all those of a pair each (``x``), with chain and rank. Pairs with equally many are chained at once."""
    for b in batches:
        lists = b.column("x")
        ends = lists.offsets.to_numpy().astype("i8") - lists.offsets[0].as_py()
        inner = lists.flatten()
        cols = dict(zip([inner.type.field(i).name for i in range(inner.type.num_fields)], inner.flatten(), strict=True))
        flat = {c: cols[c].to_numpy(zero_copy_only=False).astype("i8") for c in PIECE}
        chain, rank = np.zeros(len(inner), "i8"), np.zeros(len(inner), "i8")
        size = np.diff(ends)
        for m in np.unique(size[(size > 1) & (size <= WIDE)]).tolist():
            at = ends[:-1][size == m][:, None] + np.arange(m)
            chain[at], rank[at] = chain_many({c: v[at] for c, v in flat.items()})
        for i, j in zip(ends[:-1][size > WIDE].tolist(), ends[1:][size > WIDE].tolist(), strict=True):
            place = {int(o): n for n, o in enumerate(flat["ovl_id"][i:j], i)}
            for o, c, r in chain_pair({c: v[i:j] for c, v in flat.items()}):
                chain[place[o]], rank[place[o]] = c, r
        names = [c for c in cols if c != "unique_bp"]
        yield pa.RecordBatch.from_arrays([*(cols[c] for c in names), pa.array(chain), pa.array(rank)], [*names, "chain", "rank"])


def chain_overlaps(o: DataFrame, iv: DataFrame) -> DataFrame:
    """Adds chain and rank (both from 0) to live overlaps; identity overlaps are left out.

    Overlaps that lie by A stay where they are: a read's intervals come to them as one array, a pair's overlaps meet as one, and rows come back
    whole, so that nothing is joined again.
    """
    live = purge(flagged(o)).where("aread <> bread")
    kind = iv.schema["rid"].dataType
    spans = merge_intervals(iv.select("rid", "beg", "end_"), by=("rid",)).groupBy(F.col("rid").cast(kind).alias("_rid")).agg(F.collect_list(F.struct("beg", "end_")).alias("_iv"))
    shared = F.aggregate("_iv", F.lit(0).cast("long"), lambda n, x: n + F.greatest(F.least(x["end_"], F.col("aepos")) - F.greatest(x["beg"], F.col("abpos")), F.lit(0)).cast("long"))
    u = live.join(spans, F.col("aread") == F.col("_rid"), "left").withColumn("unique_bp", F.col("aepos") - F.col("abpos") - F.coalesce(shared, F.lit(0))).drop("_iv", "_rid")
    pairs = u.groupBy("aread", "bread").agg(F.collect_list(F.struct(*u.columns)).alias("x")).select("x")
    rows = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in live.schema)
    return pairs.mapInArrow(chain_pairs, f"{rows}, chain long, rank long")


def in_dust(gaps: DataFrame, dust: DataFrame, pct: int) -> DataFrame:
    """ovl_id of gaps (ovl_id, rid, beg, end_) of which ``pct`` percent or more are low-complexity."""
    hit = interval_join(gaps, merge_intervals(dust, by=("rid",)).select("rid", F.col("beg").alias("db"), F.col("end_").alias("de")), "rid", ("beg", "end_"), ("db", "de"))
    return hit.groupBy("ovl_id", "beg", "end_").agg(F.sum("bp").alias("bp")).where(100 * F.col("bp") >= pct * (F.col("end_") - F.col("beg"))).select("ovl_id", F.lit(True).alias("_dust"))


def with_gaps(chains: DataFrame) -> DataFrame:
    """Adds agap and bgap, the distances to the chain's previous overlap (null for its first)."""
    w = Window.partitionBy("aread", "bread", "chain").orderBy("rank")
    return chains.withColumn("agap", F.col("abpos") - F.lag("aepos").over(w)).withColumn("bgap", F.col("bbpos") - F.lag("bepos").over(w))


def validate_chains(chains: DataFrame, trim: DataFrame, dust: DataFrame, fuzz: int = 200, cover: int = 50, max_div: float = 0.2, min_len: int = 1000, keep_best: bool = False) -> DataFrame:
    """One row per chain with ``valid``: proper at both ends, no inner gap over ``fuzz`` unless 80 % of it is low-complexity, enough of the shorter read covered, long and similar enough on both reads.

    ``keep_best``: of the valid chains of a pair only the first stays valid.
    """
    g = with_ends(with_gaps(chains), trim)
    wide = g.where((F.col("agap") > fuzz) | (F.col("bgap") > fuzz))
    spans = wide.where("agap > 0").select("ovl_id", F.col("aread").alias("rid"), (F.col("abpos") - F.col("agap")).alias("beg"), F.col("abpos").alias("end_"))
    g = g.join(in_dust(spans, dust, 80), "ovl_id", "left")
    span_a, span_b = F.sum(F.col("aepos") - F.col("abpos")), F.sum(F.col("bepos") - F.col("bbpos"))
    s = g.groupBy("aread", "bread", "chain").agg(
        F.count(F.lit(1)).alias("n"), F.min("abpos").alias("ab"), F.max("aepos").alias("ae"), F.min("bbpos").alias("bb"), F.max("bepos").alias("be"), F.sum("diffs").alias("diffs"), span_a.alias("sa"), span_b.alias("sb"),
        F.first("atb").alias("atb"), F.first("ate").alias("ate"), F.first("btb").alias("btb"), F.first("bte").alias("bte"),
        F.count_if(((F.col("agap") > fuzz) | (F.col("bgap") > fuzz)) & F.col("_dust").isNull()).alias("bad_gaps"),
    )
    c = F.col
    proper = ((c("ab") <= c("atb") + fuzz) | (c("bb") <= c("btb") + fuzz)) & ((c("ae") >= c("ate") - fuzz) | (c("be") >= c("bte") - fuzz))
    enough = 100 * F.least("sa", "sb") >= cover * F.least(c("ate") - c("atb"), c("bte") - c("btb"))
    ok = proper & enough & (c("bad_gaps") == 0) & (c("diffs") <= max_div * F.least("sa", "sb")) & (c("sa") > min_len) & (c("sb") > min_len)
    out = s.withColumn("valid", ok)
    if keep_best:
        first = F.min(F.when(F.col("valid"), F.col("chain"))).over(Window.partitionBy("aread", "bread"))
        out = out.withColumn("valid", F.col("valid") & (F.col("chain") == first))
    return out.select("aread", "bread", "chain", "n", "ab", "ae", "bb", "be", "bad_gaps", "valid")


def stitch_chains(chains: DataFrame, dust: DataFrame, gap: int = 100, gap_dust: int = 1000, most: int = 1) -> DataFrame:
    """Pieces (aread, bread, chain, piece, abpos, aepos, bbpos, bepos, diffs) of chains that come down to ``most`` or fewer pieces.

    Neighbours join if both their gaps are below ``gap``, or below ``gap_dust`` where A's gap is low-complexity.
    """
    g = with_gaps(chains)
    spans = g.where("agap > 0").select("ovl_id", F.col("aread").alias("rid"), (F.col("abpos") - F.col("agap")).alias("beg"), F.col("abpos").alias("end_"))
    g = g.join(in_dust(spans, dust, 80), "ovl_id", "left")
    both = F.greatest("agap", "bgap")
    new = F.coalesce(~((both < gap) | ((both < gap_dust) & F.col("_dust").isNotNull())), F.lit(True)).cast("int")
    w = Window.partitionBy("aread", "bread", "chain").orderBy("rank")
    p = g.withColumn("piece", F.sum(new).over(w) - 1).withColumn("_k", F.max("piece").over(Window.partitionBy("aread", "bread", "chain")))
    return p.where(F.col("_k") < most).groupBy("aread", "bread", "chain", "piece").agg(F.min("abpos").alias("abpos"), F.max("aepos").alias("aepos"), F.min("bbpos").alias("bbpos"), F.max("bepos").alias("bepos"), F.sum("diffs").alias("diffs"))


def filter_circular(o: DataFrame, tips: int = 1000, gap: int = 1000, fuzz: int = 25, cover: int = 75, min_len: int | None = None, max_len: int | None = None) -> DataFrame:
    """Pair groups that lie around a circular B: one strand, gaps of at most ``gap``, at most one wrap past B's end, tips and cover; others are discarded.

    With ``min_len``, B-reads outside [min_len, max_len] get RLEN.
    """
    o = flagged(o)
    w = Window.partitionBy("aread", "bread").orderBy("abpos", "ovl_id")
    last_a, last_b = F.lag("aepos").over(w), F.lag("bepos").over(w)
    g = purge(o).withColumn("_ag", F.col("abpos") - last_a).withColumn("_wrap", F.coalesce(F.col("bbpos") < last_b - fuzz, F.lit(False))).withColumn("_bg", F.when(F.col("_wrap"), F.col("blen") - last_b + F.col("bbpos")).otherwise(F.col("bbpos") - last_b))
    s = g.groupBy("aread", "bread").agg(
        F.count_distinct("comp").alias("_s"), F.max(F.greatest("_ag", "_bg")).alias("_g"), F.count_if("_wrap").alias("_w"), F.min("abpos").alias("_ab"), F.max("aepos").alias("_ae"), F.first("alen").alias("_al"), F.first("blen").alias("_bl"), F.sum(F.col("bepos") - F.col("bbpos")).alias("_c")
    )
    ok = (F.col("_s") == 1) & (F.coalesce("_g", F.lit(0)) <= gap) & (F.col("_w") <= 1) & (F.col("_ab") <= tips) & (F.col("_al") - F.col("_ae") <= tips) & (100 * F.col("_c") >= cover * F.col("_bl"))
    out = o.join(s.select("aread", "bread", ok.alias("_ok")), ["aread", "bread"], "left")
    out = out.withColumn("flags", set_flag(F.col("flags"), "DISCARD", ~F.coalesce("_ok", F.lit(False)))).drop("_ok")
    if min_len is not None:
        out = discard(out, "RLEN", (F.col("blen") < min_len) | (F.col("blen") > (max_len or 2**31 - 1)))
    return out


def separate(chains: DataFrame, trim: DataFrame, kind: int = 0, fuzz: int = 1000) -> DataFrame:
    """Pairs by their chains. kind 0: pairs with a chain that is proper at both ends go. kind 1: only pairs with one chain that is not proper stay."""
    e = with_ends(chains, trim)
    s = e.groupBy("aread", "bread", "chain").agg(*(F.min(c).alias(c) for c in ("abpos", "bbpos", "atb", "btb", "ate", "bte")), F.max("aepos").alias("aepos"), F.max("bepos").alias("bepos"))
    proper: Column = ((F.col("abpos") <= F.col("atb") + fuzz) | (F.col("bbpos") <= F.col("btb") + fuzz)) & ((F.col("aepos") >= F.col("ate") - fuzz) | (F.col("bepos") >= F.col("bte") - fuzz))
    p = s.groupBy("aread", "bread").agg(F.count_if(proper).alias("_p"), F.count(F.lit(1)).alias("_n"))
    stay = p.where("_p = 0" if kind == 0 else "_p = 0 and _n = 1").select("aread", "bread")
    return chains.join(stay, ["aread", "bread"], "left_semi")


def contig_relations(chains: DataFrame, fuzz: int = 1000) -> DataFrame:
    """contained, bridge or repeat for each chain of contig A (aread) against contig B (bread).

    contained: half or more of A covered; bridge: A covered by min(50000, 3 fuzz) with 100 kb beyond both ends; repeat: 40 % or more.
    """
    s = chains.groupBy("aread", "bread", "chain").agg(F.sum(F.col("aepos") - F.col("abpos")).alias("cov"), F.min("abpos").alias("ab"), F.max("aepos").alias("ae"), F.first("alen").alias("alen"))
    kind = F.when(2 * F.col("cov") >= F.col("alen"), "contained").when((F.col("cov") >= min(50_000, 3 * fuzz)) & (F.col("ab") >= 100_000) & (F.col("alen") - F.col("ae") >= 100_000), "bridge").when(10 * F.col("cov") >= 4 * F.col("alen"), "repeat")
    return s.withColumn("relation", kind).where("relation is not null").select("aread", "bread", "chain", "cov", "relation")


def with_overhang(chains: DataFrame) -> DataFrame:
    """Adds what each overlap shares with the chain's previous one on A and B (its_a, its_b) and the gaps between them (gap_a, gap_b); 0 for the first."""
    w = Window.partitionBy("aread", "bread", "chain").orderBy("rank")
    for name, beg, end in (("a", "abpos", "aepos"), ("b", "bbpos", "bepos")):
        over = F.coalesce(F.lag(end).over(w) - F.col(beg), F.lit(0))
        chains = chains.withColumn(f"its_{name}", F.greatest(over, F.lit(0))).withColumn(f"gap_{name}", F.greatest(-over, F.lit(0)))
    return chains


def judge_chains(chains: DataFrame, trim: DataFrame, dust: DataFrame, fuzz: int = 200, cover: int = 50, max_div: float = 20.0, min_len: int = 1000, keep_best: bool = False) -> DataFrame:
    """One row per chain of ``chain_overlaps``, with what speaks for it and ``valid`` (0, 1).

    anchored: an overlap of the pair has neither REPEAT nor TRIM. proper: both ends of the chain lie within ``fuzz`` of a trimmed end of A or
    B. bad_gaps: gaps over ``fuzz``, on A or B, of which less than 80 % is low-complexity on that read. enough: covers ``cover`` percent of the
    shorter read (on the read where it covers more). alike: no more than ``max_div`` percent differences on both. long_: covers more than
    ``min_len`` of both. nested: it shares more than min(fuzz, 1000) bases of A or B with an earlier valid chain of the pair, or one of
    its overlaps lies inside one of the same strand on either read. Chains are judged by falling length; ``keep_best``: only the first valid one stays.
    """
    c = F.col
    g = with_ends(with_overhang(flagged(chains)), trim)
    fb, fe = forward_b(c("comp"), c("blen"), c("bbpos") - c("gap_b"), c("bbpos"))
    spans = g.where(c("gap_a") > fuzz).select("ovl_id", c("aread").alias("rid"), (c("abpos") - c("gap_a")).alias("beg"), c("abpos").alias("end_"))
    dust_a = in_dust(spans, dust, 80).select("ovl_id", F.lit(True).alias("_da"))
    spans = g.where(c("gap_b") > fuzz).select("ovl_id", c("bread").alias("rid"), fb.alias("beg"), fe.alias("end_"))
    dust_b = in_dust(spans, dust, 80).select("ovl_id", F.lit(True).alias("_db"))
    g = g.join(dust_a, "ovl_id", "left").join(dust_b, "ovl_id", "left")
    bad = ((c("gap_a") > fuzz) & c("_da").isNull()).cast("int") + ((c("gap_b") > fuzz) & c("_db").isNull()).cast("int")
    span_a, span_b = F.sum(c("aepos") - c("abpos")), F.sum(c("bepos") - c("bbpos"))
    anchor = (c("flags").bitwiseAND(F.lit(bit("REPEAT") | bit("TRIM"))) == 0).cast("int")
    s = g.groupBy("aread", "bread", "chain").agg(
        F.count(F.lit(1)).alias("n"), F.min("abpos").alias("ab"), F.max("aepos").alias("ae"), F.min("bbpos").alias("bb"), F.max("bepos").alias("be"), F.first("comp").alias("comp"),
        F.first("alen").alias("alen"), F.first("blen").alias("blen"), F.first("atb").alias("atb"), F.first("ate").alias("ate"), F.first("btb").alias("btb"), F.first("bte").alias("bte"),
        F.sum("diffs").alias("diffs"), span_a.alias("sa"), span_b.alias("sb"), (span_a - F.sum("its_a")).alias("ca"), (span_b - F.sum("its_b")).alias("cb"),
        F.sum(bad).alias("bad_gaps"), F.max(anchor).alias("_an"), F.collect_list(F.struct("abpos", "aepos", "bbpos", "bepos")).alias("pieces"),
    )
    proper = ((c("ab") <= c("atb") + fuzz) | (c("bb") <= c("btb") + fuzz)) & ((c("ae") + fuzz >= c("ate")) | (c("be") + fuzz >= c("bte")))
    s = s.withColumn("proper", proper).withColumn("enough", 100 * F.greatest("ca", "cb") >= cover * F.least("alen", "blen"))
    s = s.withColumn("alike", 100.0 * c("diffs") <= max_div * F.least("sa", "sb")).withColumn("long_", F.least("ca", "cb") > min_len)
    s = s.withColumn("ok", c("proper") & c("enough") & c("alike") & c("long_") & (c("bad_gaps") == 0))
    shown = ["chain", "n", "ca", "cb", "bad_gaps", "proper", "enough", "alike", "long_", "ok"]
    kept = ["comp", "ab", "ae", "bb", "be"]
    # The chains of two reads, longest first; an array of them is as small as the pair's overlaps.
    one = F.struct((-c("sa")).alias("size"), *shown, *kept, "pieces")
    pairs = s.groupBy("aread", "bread").agg(F.max("_an").alias("anchored"), F.array_sort(F.collect_list(one)).alias("all"))
    shared = lambda x, y, b, e: F.least(x[e], y[e]) - F.greatest(x[b], y[b])

    def inside(x: Column, y: Column) -> Column:
        hit = F.exists(x["pieces"], lambda p: ((p["abpos"] >= y["ab"]) & (p["aepos"] <= y["ae"])) | ((p["bbpos"] >= y["bb"]) & (p["bepos"] <= y["be"])))
        return (shared(x, y, "ab", "ae") > min(fuzz, 1000)) | (shared(x, y, "bb", "be") > min(fuzz, 1000)) | ((x["comp"] == y["comp"]) & hit)

    kind = ", ".join(f"{n}: {s.schema[n].dataType.simpleString()}" for n in kept)
    start = F.struct(F.array().cast(f"array<struct<{kind}>>").alias("kept"), F.array().cast("array<struct<chain: bigint, nested: int, valid: int>>").alias("said"))

    def judge(t: Column, x: Column) -> Column:
        nested = F.exists(t["kept"], lambda y: inside(x, y))
        valid = x["ok"] & ~nested & (c("anchored") == 1)
        if keep_best:
            valid = valid & (F.size(t["kept"]) == 0)
        me = F.struct(*(x[n].alias(n) for n in kept))
        word = F.struct(x["chain"].cast("long").alias("chain"), nested.cast("int").alias("nested"), valid.cast("int").alias("valid"))
        return F.struct(F.when(valid, F.concat(t["kept"], F.array(me))).otherwise(t["kept"]).alias("kept"), F.concat(t["said"], F.array(word)).alias("said"))

    said = F.aggregate("all", start, judge)["said"]
    out = pairs.select("aread", "bread", "anchored", F.inline(F.arrays_zip(c("all").alias("x"), said.alias("s"))))
    flags = [c(f"x.{n}").cast("int").alias(n) for n in ("proper", "enough", "alike", "long_")]
    return out.select("aread", "bread", "x.chain", "anchored", "x.n", c("x.ca").alias("cover_a"), c("x.cb").alias("cover_b"), "x.bad_gaps", *flags, "s.nested", "s.valid")


def separate_pairs(chains: DataFrame, kind: int = 0, ends: int = 1000) -> DataFrame:
    """Overlaps that stay, by the longest chain of their pair.

    A chain is whole if it starts within ``ends`` of the begin of A or B and stops within ``ends`` of the end of one, its overlaps share no more
    than ``ends`` bases on either read, and its gaps on each read are less than 30 % of what it covers. kind 0: pairs with a whole chain
    go. kind 1: pairs with one chain, whole and of more than one overlap, stay.
    """
    c = F.col
    size = F.greatest(c("aepos") - c("abpos"), c("bepos") - c("bbpos")) - F.greatest("its_a", "its_b")
    w, pair = Window.partitionBy("aread", "bread", "chain"), Window.partitionBy("aread", "bread")
    whole = (F.least(F.min("abpos").over(w), F.min("bbpos").over(w)) < ends) & ((F.max("aepos").over(w) + ends > c("alen")) | (F.max("bepos").over(w) + ends > c("blen")))
    whole = whole & (F.max(F.greatest("its_a", "its_b")).over(w) <= ends) & (3 * F.sum(size).over(w) > 10 * F.greatest(F.sum("gap_a").over(w), F.sum("gap_b").over(w)))
    d = with_overhang(chains.repartition("aread", "bread")).select(*chains.columns, whole.alias("_w"), F.count(F.lit(1)).over(w).alias("_k"), F.sum(c("aepos") - c("abpos")).over(w).alias("_sa"))
    # Windows over a pair, so that its rows needn't be joined with what is found of it.
    d = d.withColumns({"_b": F.max_by(F.struct("_w", "_k"), F.struct("_sa", -c("chain"))).over(pair), "_lo": F.min("chain").over(pair), "_hi": F.max("chain").over(pair)})
    return d.where("not _b._w" if kind == 0 else "_b._w and _lo = _hi and _b._k > 1").select(*chains.columns)
