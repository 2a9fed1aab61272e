"""Mixing sources to target weights by the cube method (operator 2).

A document that its source wants r times on average is taken floor(r) times for certain and once
more with probability r - floor(r). Which documents get the extra turn is drawn by the cube method:
inclusion probabilities of three documents at a time move along the null space of the two
constraints (number of documents, number of words) until one of them is 0 or 1, so both totals
stay exact all the way. The flight runs in blocks of a source, then over what the blocks left
undecided, and so on; at the end at most two documents of a source are undecided, and landing
takes the choice whose word total is nearest to the target.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, counted, mark_of, packed, slices

BLOCK = 8192
EPS = 1e-9


def word_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, mark (64 bits that hang on the whole row), size: the number of runs of other bytes than ASCII white space (null: 0)."""

    def run(batches):
        for b in batches:
            for start, end, texts in slices(b):
                raw = texts.cast(pa.binary())
                size = [len(raw[i].as_py().split()) for i in range(len(raw))]
                part = b.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("source"), part.column("mark"), pa.array(size, pa.int64())], ["doc_id", "source", "mark", "size"])

    return docs.select("doc_id", "source", "text", mark_of(docs).alias("mark")).mapInArrow(run, "doc_id long, source string, mark long, size long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """source, source_size, n, target: one row per source.

    Sources stand in the order of their code points, null last, and take the weights in turn. They
    share the sum of all sizes by weight; a target stops at ``most`` times its source's size and the
    excess is shared anew by weight among the others until none is above.

    With a level t, targets are min(weight * t, most * size), and t grows until all is shared:
    sources fill up in the order of most * size / weight, so running sums over the sources in that order
    give t in one step. There is one row for each source, never for each document.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    by = by.withColumn("weight", turn.cast("double")).withColumn("full_at", most * F.col("source_size") / F.col("weight"))
    by = by.crossJoin(F.broadcast(by.agg(F.sum("source_size").alias("total"))))  # one row
    rising = Window.orderBy("full_at", F.col("source").isNull(), F.col("source").cast("binary"))
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    by = by.withColumn("filled", F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0.0)))
    by = by.withColumn("open", F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)))
    by = by.withColumn("level", (F.col("total") - F.col("filled")) / F.col("open"))
    # The first source that the level of its turn does not fill ends the filling.
    first = by.where(F.col("level") <= F.col("full_at")).agg(F.min_by("level", F.struct("full_at", F.col("source").isNull(), F.col("source").cast("binary"))).alias("final"))
    by = by.crossJoin(F.broadcast(first))
    target = F.least(most * F.col("source_size"), F.coalesce(F.col("weight") * F.col("final"), most * F.col("source_size")))
    return by.select("source", "source_size", "n", target.cast("double").alias("target"))


#: Units so many times as large as the mean of their block are decided first.
LARGE = 4


def large_first(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Decide the large units of a block, one after another, each against all others at once.

    Among three units a large one hardly moves, and would be left for the landing. Here the direction is 1 for the unit, and for each other one its
    variance times a line in its size, such that documents and words stay; the step is drawn as in the flight.
    """
    out, size = p.astype("f8").copy(), size.astype("f8")
    open_ = (out > EPS) & (out < 1 - EPS)
    if open_.sum() < 8:
        return out
    big = np.flatnonzero(open_ & (size > LARGE * size[open_].mean()))
    for a in big[np.argsort(-size[big], kind="stable")]:
        for _ in range(64):
            if not EPS < out[a] < 1 - EPS:
                break
            w = out * (1 - out)
            w[a] = 0
            s0, s1, s2 = w.sum(), (w * size).sum(), (w * size * size).sum()
            det = s0 * s2 - s1 * s1
            if not s2 > 0:
                break
            if det > 1e-9 * s0 * s2:
                u = -((s2 - s1 * size[a]) + (s0 * size[a] - s1) * size) / det * w
            else:  # all others are of one size: the words alone stay
                u = -size[a] / s2 * size * w
            u[a] = 1.0
            with np.errstate(divide="ignore", invalid="ignore"):
                up = np.where(u > 0, (1 - out) / u, np.where(u < 0, -out / u, np.inf)).min()
                down = np.where(u > 0, out / u, np.where(u < 0, (out - 1) / u, np.inf)).min()
            out = out + (up if rng.random() * (up + down) < down else -down) * u
            out[out < EPS], out[out > 1 - EPS] = 0.0, 1.0
    return out


def fly(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move the probabilities of one block until fewer than three lie between 0 and 1."""
    out, live = large_first(p, size, rng), []
    draws, k = rng.random(len(p) + 3), 0
    for i in range(len(out)):
        if EPS < out[i] < 1 - EPS:
            live.append(i)
        if len(live) < 3:
            continue
        a, b, c = live
        # The null space of the rows (1, 1, 1) and (size) over three documents.
        u = (float(size[c] - size[b]), float(size[a] - size[c]), float(size[b] - size[a]))
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        q = (out[a], out[b], out[c])
        up = min((1 - x) / v if v > 0 else -x / v for x, v in zip(q, u, strict=True) if v)
        down = min(x / v if v > 0 else (x - 1) / v for x, v in zip(q, u, strict=True) if v)
        step = up if draws[k] * (up + down) < down else -down
        k += 1
        for j, x, v in zip(live, q, u, strict=True):
            x += step * v
            out[j] = 0.0 if x < EPS else 1.0 if x > 1 - EPS else x
        live = [j for j in live if 0 < out[j] < 1]
    return out


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Decide the last few: the choice with the nearest total of words, then of documents."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    out = p.copy()
    best = min(itertools.product((0.0, 1.0), repeat=len(open_)), key=lambda c: (abs(float(size[open_] @ (np.array(c) - p[open_]))), abs(float(np.sum(np.array(c) - p[open_]))), c))
    out[open_] = best
    return out


def cube(units: DataFrame, seed: int, levels: int = 3) -> DataFrame:
    """Decide each unit (did, mark, copy, source, size, p): did, mark, copy -> extra (0 or 1).

    A level deals the undecided units of a source into blocks of about BLOCK by a hash of their
    identifier, so no task holds a whole source. Each level leaves two undecided units per block at most;
    three levels and landing suffice for 8192 * 4096^3 documents of one source.
    """
    key = ["did", "mark", "copy"]
    schema = "did long, mark long, copy long, source string, size long, p double"

    def flight(level: int):
        def run(_: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(key, kind="stable", ignore_index=True)
            # Drawn from the block's own content, so that a task that runs again decides the same.
            own = [int(pd.util.hash_array(pdf[c].to_numpy("i8")).sum() & np.uint64(2**32 - 1)) for c in key]
            rng = np.random.default_rng([seed, level, *own])
            shuffled = rng.permutation(len(pdf))
            p, size = pdf["p"].to_numpy()[shuffled], pdf["size"].to_numpy()[shuffled]
            p = fly(p, size, rng)
            if level == levels:
                p = land(p, size)
            back = np.empty_like(p)
            back[shuffled] = p
            return pdf.drop(columns=["p", "_block"]).assign(p=back)[[*key, "source", "size", "p"]]

        return run

    done, live = None, units
    for level in range(levels + 1):
        if level < levels:
            count = live.groupBy("source").agg(F.count(F.lit(1)).alias("_n"))
            held = live.join(count, live["source"].eqNullSafe(count["source"])).drop(count["source"])
            block = F.pmod(F.xxhash64(*key, F.lit(level)), F.ceil(F.col("_n") / BLOCK))
        else:
            held, block = live, F.lit(0)
        flown = checkpointed(held.withColumn("_block", block).groupBy("source", "_block").applyInPandas(flight(level), schema))
        decided = flown.where("p in (0, 1)")
        done = decided if done is None else done.unionByName(decided)
        live = flown.where("p > 0 and p < 1")
    return done.select(*key, F.col("p").cast("long").alias("extra"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, seed: int = 7) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, turns, taken.

    turns: how often the mix takes the document, ``most`` times at most; taken = turns * size. Sizes
    count words; null texts have none, and documents without words take part but add nothing. A null
    source is a source of its own. Rows that repeat an identifier are documents of their own. All draws hang on
    identifiers and sizes alone, so reruns agree. A table without words gets targets of 0 and takes nothing. Further
    columns are not carried.
    """
    out = mixed(docs, weights, most, seed)
    return out.select("doc_id", "source", "size", "source_size", "target", "turns", (F.col("turns") * F.col("size")).alias("taken"))


#: Stands for a null identifier inside; ``mark`` tells it from a row that has this one.
NO_ID = -(1 << 63)


def mixed(docs: DataFrame, weights: tuple[int, ...], most: float, seed: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, did, mark, copy (which of the rows that are equal in all columns), source, size, source_size, target, turns."""
    key = ["did", "mark", "copy"]
    alike = word_sizes(docs).groupBy("doc_id", "source", "size", "mark").agg(F.count(F.lit(1)).alias("_n"))
    sizes = counted(alike, "_n", "copy").drop("_n")
    sizes = checkpointed(sizes.withColumn("did", F.coalesce("doc_id", F.lit(NO_ID))))
    goal = targets(sizes, weights, most)
    joined = sizes.join(goal, sizes["source"].eqNullSafe(goal["source"])).drop(goal["source"])
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    joined = checkpointed(joined.withColumn("rate", rate).withColumn("certain", F.floor(F.col("rate") + EPS)))
    p = F.greatest(F.lit(0.0), F.col("rate") - F.col("certain"))
    units = joined.select(*key, "source", "size", F.when(p < 1e-9, 0.0).otherwise(p).alias("p")).where("p > 0")
    return joined.join(cube(units, seed), key, "left").withColumn("turns", F.col("certain") + F.coalesce("extra", F.lit(0)))


def mix_rows(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, seed: int = 7) -> DataFrame:
    """The rows of ``docs``, all columns under their own names, each as often as ``mix`` takes it.

    Rows that are equal in all columns are there as often as all of them are taken. An empty table gives an empty table.
    """
    turns = mixed(docs, weights, most, seed).groupBy("did", "mark").agg(F.sum("turns").alias("turns")).where("turns > 0")
    rows = packed(docs, F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), mark_of(docs).alias("mark"))
    taken = rows.join(turns, ["did", "mark"]).dropDuplicates(["did", "mark"])
    return counted(taken, "turns", "turn").select("row.*")
