"""Approximate nearest neighbours by inner product with a permutation index (operator 9).

Pivots come from a bounded sample. Every vector is represented by the order of its ``length`` nearest pivots and posted once, in
the list of its nearest centre (one of the sample) and its band of norms. A query visits every list that can hold a
vector with the score that a neighbour needs: that follows from the angle between query and centre, the widest angle and the largest norm of
the list, and is a bound. In a list the inverted file over pivots gives the footrule distance between the orders. As the measure is an
inner product, a long vector may be farther by angle: each is ranked by its norm times the largest cosine that its footrule nearness lets
expect. What falls short of the score is left out, and the rest is ranked anew by the exact inner product.

The needed score is read off a bounded sample for each query. What cosine a nearness lets expect is measured on pairs of the sample, near and
far, and set so high that the sample's own neighbours by inner product are let through. That part is a statement on averages; recall against
brute force is measured in the tests. Equal vectors are one vector with their smallest identifiers, so copies crowd out nothing. Lists of more
than BLOCK vectors are dealt into several tasks, and so are more than ASKED queries.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

LIST, BLOCK, CENTRES, ASKED = 2048, 8192, 2048, 16384
#: Bands of norms are powers of two; beyond so many from length 1 all share the last band.
BANDS = 31


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of rows that take part: an identifier, no null or non-finite component, not zero."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    return vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ~bad & some).select("vec_id", v.alias("embedding"))


def orders(unit: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first."""
    near = -(unit @ pivots.T)
    at = np.argpartition(near, length - 1, axis=1)[:, :length]
    return np.take_along_axis(at, np.argsort(np.take_along_axis(near, at, 1), axis=1, kind="stable"), 1).astype("i4")


class Block:
    """The inverted file over one list: for each pivot a row with the place at which each vector names it, or ``length``."""

    def __init__(self, x: np.ndarray, order: np.ndarray, pivots: int) -> None:
        self.x, self.length, self.norm = x, order.shape[1], np.linalg.norm(x, axis=1)
        kind = "i2" if self.length <= 180 else "i4"
        self.places = np.full((pivots, len(x)), self.length, kind)
        self.places[order.T, np.arange(len(x))] = np.arange(self.length, dtype=kind)[:, None]
        self.own = np.arange(self.length, dtype=kind)[:, None]

    def nearness(self, order: np.ndarray) -> np.ndarray:
        """How far below its largest value the footrule distance to each vector lies (halved; larger is nearer)."""
        return self.length**2 - np.maximum(self.places[order], self.own).sum(0, dtype=self.places.dtype)

    def candidates(self, order: np.ndarray, reach: np.ndarray, needed: float, least: int) -> np.ndarray:
        """Rows that may have a product of ``needed`` with a query of length 1, or come nearest to it if those are fewer than ``least``.

        ``reach``: the largest cosine to expect, by nearness.
        """
        margin = self.norm * reach[self.nearness(order)] - needed
        at = np.flatnonzero(margin >= 0)
        if len(at) < least:
            at = np.argpartition(-margin, least - 1)[:least] if least < len(margin) else np.arange(len(margin))
        return at


@dataclass
class Guide:
    """What a bounded sample tells, and the table of lists."""

    pivots: np.ndarray
    sample: np.ndarray
    centres: np.ndarray
    length: int
    reach: np.ndarray
    lists: pd.DataFrame | None = None

    @classmethod
    def fit(cls, sample: np.ndarray, n: int, pivots: int, length: int, k: int, caught: float) -> Guide:
        """``sample``: different vectors in random order; ``n``: how many vectors there are."""
        norm = np.linalg.norm(sample, axis=1)
        unit = sample / norm[:, None]
        p = unit[: max(1, min(pivots, len(unit) // 2))]
        centres = unit[: max(1, min(CENTRES, len(unit) // 2, math.ceil(n / LIST)))]
        length = min(length, len(p))
        out = cls(p, sample, centres, length, np.ones(length**2 + 1))
        rest, size = unit[len(p) :], norm[len(p) :]
        if len(rest) < 64 or caught >= 1:
            return out  # everything is ranked exactly
        asked, order, place = rest[:256], orders(rest, p, length), np.full((len(rest), len(p)), length)
        np.put_along_axis(place, order, np.arange(length)[None], 1)
        gain = np.stack([(length - np.maximum(place[:, o], np.arange(length))).sum(1) for o in order[: len(asked)]])
        cosine = asked @ rest.T
        off = ~np.eye(*cosine.shape, dtype=bool)
        # Cosines to expect at a nearness: mean and spread of all pairs in each of some bins, be they near or far.
        edges = np.unique(np.quantile(gain[off], np.linspace(0, 1, 65)[1:-1]))
        edges = np.unique(np.concatenate([edges, np.quantile(gain[off & (gain > edges[-1])], np.linspace(0, 1, 17)[1:-1])])) if (off & (gain > edges[-1])).any() else edges
        at = np.searchsorted(edges, gain, "right")
        many = np.bincount(at[off], minlength=len(edges) + 1)
        mean = np.bincount(at[off], cosine[off], len(edges) + 1) / np.maximum(many, 1)
        spread = np.sqrt(np.bincount(at[off], (cosine - mean[at])[off] ** 2, len(edges) + 1) / np.maximum(many, 1)) + 1e-6
        # How many spreads above the mean the sample's own neighbours by inner product are allowed, so that ``caught`` of them are found.
        product = np.where(off, cosine * size, -np.inf)
        worst = np.partition(product, -k, axis=1)[:, -k][:, None] if k < len(rest) - 1 else np.full((len(asked), 1), -np.inf)
        near = off & (product >= worst)
        short = ((worst / size - mean[at]) / spread[at])[near & (np.abs(worst) < np.inf)]
        if not len(short):
            return out
        top = mean + max(0.0, float(np.quantile(short, caught))) * spread
        top[many == 0] = -np.inf
        out.reach = np.minimum(1, np.maximum.accumulate(top))[np.searchsorted(edges, np.arange(length**2 + 1), "right")]
        return out

    def post(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Order, list, cosine with the list's centre, norm of each vector."""
        norm = np.linalg.norm(x, axis=1)
        unit = x / norm[:, None]
        near = unit @ self.centres.T
        centre = near.argmax(1)
        band = np.clip(np.floor(np.log2(norm) + 0.5), -BANDS, BANDS).astype("i8") + BANDS
        return orders(unit, self.pivots, self.length), centre * (2 * BANDS + 1) + band, near.max(1), norm

    def score(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """A score that more than ``k`` of all vectors are expected to reach with each query, and a lower one that they are all but sure to reach."""
        held = np.sort(q @ self.sample.T, axis=1)
        rank = math.ceil(1.5 * (k + 1) * held.shape[1] / max(1, int(self.lists["n"].sum()))) + 2
        return held[:, -min(held.shape[1], rank)], held[:, -min(held.shape[1], rank + 5)]

    def visits(self, q: np.ndarray, score: np.ndarray, k: int) -> list[np.ndarray]:
        """For each query the lists (row numbers of ``lists``) that can hold a vector of that score, but ``4 * (k + 1)`` vectors at least.

        No vector of a list lies farther from its centre than the one with the least cosine, and none is longer than the longest: what
        follows for the product with a query is a bound, not an estimate.
        """
        t, norm = self.lists, np.linalg.norm(q, axis=1)
        n = t["n"].to_numpy("f8")
        gamma = ((q / norm[:, None]) @ self.centres.T)[:, t["list"].to_numpy() // (2 * BANDS + 1)]
        apart = np.arccos(np.clip(gamma, -1, 1)) - np.arccos(np.clip(t["delta"].to_numpy(), -1, 1))
        bound = np.cos(np.clip(apart - 1e-7, 0, np.pi)) * norm[:, None]
        bound = bound * t["norm"].to_numpy()
        out = []
        for e, s, order in zip(bound, score, np.argsort(-bound, axis=1, kind="stable"), strict=True):
            rows = np.cumsum(n[order])
            enough = (np.append(e[order][1:], -np.inf) < s) & (rows >= min(rows[-1], 4 * (k + 1)))
            out.append(order[: int(np.argmax(enough)) + 1])
        return out


def shares(sizes: np.ndarray, total: int) -> int:
    """The least number that, taken from each of ``sizes`` as far as they go, gives ``total`` or all there is."""
    few = 1
    while np.minimum(sizes, few).sum() < min(total, sizes.sum()):
        few += 1
    return few


def keys(v: Column) -> list[Column]:
    """128 bits that stand for a vector."""
    return [F.xxhash64(v).alias("k1"), F.xxhash64(v, F.lit(1)).alias("k2")]


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, pivots: int = 512, length: int = 32, sample: int = 4096, caught: float = 0.99) -> DataFrame:
    """For each row whose vec_id is divisible by ``every``: its ``k`` nearest others by inner product.

    query_id, rank (from 1), vec_id, score (inner product of the original vectors in double precision), nearest first, ties to
    the smaller vec_id; all others if there are fewer than k. Vectors that are null, zero or hold null or
    non-finite components take no part, nor do those of another dimension than most have (the larger on a tie). Rows with the query's own
    identifier are the query; a query that is there several times is answered once. An empty table gives an empty table; further
    columns are not carried.

    ``sample``: the vectors that fit the index, those with the least hash. ``caught``: the share of the sample's own neighbours that the
    footrule must let through (1: it stops nothing). Vectors of a list are dealt into blocks of BLOCK, queries into blocks of ASKED.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    sizes = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("embedding") == sizes.dim)
    # Equal vectors are one, with the k + 1 smallest identifiers; the rank is cut before the shuffle too.
    least = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    distinct = rows.withColumn("_r", least).where(F.col("_r") <= k + 1).groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    distinct = checkpointed(distinct)
    n = distinct.count()
    held = distinct.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(sample).collect()
    guide = Guide.fit(np.array([r.embedding for r in held]), n, pivots, length, k, caught)
    sent = spark.sparkContext.broadcast(guide)  # at most ``sample`` vectors

    def post(batches):
        for pdf in batches:
            if len(pdf):
                order, pdf["list"], pdf["delta"], pdf["norm"] = sent.value.post(np.array(pdf["embedding"].tolist()))
                pdf["orders"] = [o.tobytes() for o in order]
                yield pdf

    index = checkpointed(distinct.mapInPandas(post, "embedding array<double>, ids array<long>, list long, delta double, norm double, orders binary"))
    # At most CENTRES * (2 * BANDS + 1) rows.
    lists = index.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("norm"), F.min("delta").alias("delta")).toPandas()
    guide.lists = lists.assign(deal=np.ceil(lists["n"] / BLOCK).astype("i8")).sort_values("list", ignore_index=True)
    told = spark.sparkContext.broadcast(guide)

    def ask(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            g, q = told.value, np.array(pdf["embedding"].tolist())
            score, floor = g.score(q, k)
            deal, name, size = (g.lists[c].to_numpy() for c in ("deal", "list", "n"))
            order = orders(q / np.linalg.norm(q, axis=1, keepdims=True), g.pivots, g.length)
            visits = g.visits(q, score, k)
            at = np.concatenate(visits)
            few = np.repeat([shares(size[v] // deal[v], 2 * (k + 1)) for v in visits], list(map(len, visits)))
            i = np.repeat(np.repeat(np.arange(len(q)), list(map(len, visits))), deal[at])
            salt, few, at = np.concatenate([np.arange(d) for d in deal[at]]), np.repeat(few, deal[at]), np.repeat(at, deal[at])
            raw, own = np.array([v.tobytes() for v in q], object), np.array([o.tobytes() for o in order], object)
            yield pd.DataFrame({"k1": pdf["k1"].to_numpy()[i], "k2": pdf["k2"].to_numpy()[i], "q": raw[i], "order": own[i], "score": score[i], "floor": floor[i], "few": few, "list": name[at], "salt": salt})

    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", "embedding", *keys(F.col("embedding")))
    parts = max(1, -(-queries.count() // ASKED))
    asked = queries.dropDuplicates(["k1", "k2"]).select("k1", "k2", "embedding").mapInPandas(ask, "k1 long, k2 long, q binary, order binary, score double, floor double, few long, list long, salt long").withColumn("part", F.pmod("k1", F.lit(parts)))
    dealt = F.broadcast(spark.createDataFrame(guide.lists[["list", "deal"]]))
    stored = index.join(dealt, "list").select("embedding", "ids", "orders", "list", F.pmod(F.xxhash64("embedding"), F.col("deal")).alias("salt")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def search(stored: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        k1, k2, vec_id, scores = ([np.zeros(0, t)] for t in ("i8", "i8", "i8", "f8"))
        if len(stored) and len(asked):
            g = told.value
            block = Block(np.array(stored["embedding"].tolist()), np.frombuffer(b"".join(stored["orders"]), "i4").reshape(len(stored), -1), len(g.pivots))
            ids = stored["ids"].to_numpy()
            for a in asked.itertuples(index=False):
                q = np.frombuffer(a.q)
                at = block.candidates(np.frombuffer(a.order, "i4"), g.reach, a.score / np.linalg.norm(q), max(64, k + 1))
                score = (block.x[at] * q).sum(1)
                if len(at) > a.few:  # what reaches the floor, and the few best anyway; no more than k + 1, and what equals the last of them
                    falling = np.sort(score)[::-1][: k + 1]
                    best = np.flatnonzero(score >= max(falling[-1], min(a.floor, falling[min(a.few, len(falling)) - 1])))
                    at, score = at[best], score[best]
                each = np.fromiter(map(len, ids[at]), "i8", len(at))
                own, score = np.concatenate(ids[at]), np.repeat(score, each)
                if len(own) > k + 1:
                    best = np.lexsort((own, -score))[: k + 1]
                    own, score = own[best], score[best]
                k1.append(np.full(len(own), a.k1))
                k2.append(np.full(len(own), a.k2))
                vec_id.append(own)
                scores.append(score)
        return pd.DataFrame({"k1": np.concatenate(k1), "k2": np.concatenate(k2), "vec_id": np.concatenate(vec_id), "score": np.concatenate(scores)})

    found = stored.groupBy("list", "salt", "part").cogroup(asked.groupBy("list", "salt", "part")).applyInPandas(search, "k1 long, k2 long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "vec_id"))
    best = found.withColumn("_r", rank).where(F.col("_r") <= k + 1).groupBy("k1", "k2").agg(F.collect_list(F.struct("vec_id", "score")).alias("best"))
    pairs = queries.select(F.col("vec_id").alias("query_id"), "k1", "k2").distinct().join(best, ["k1", "k2"]).select("query_id", F.inline("best")).where("vec_id != query_id")
    # An identifier with several vectors is one query.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
