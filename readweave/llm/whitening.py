"""Whitening of embeddings by a matrix-free Jacobi-Davidson eigensolver (operator 12).

No covariance is ever formed. Every product V·w is one pass over the centred vectors, which Spark holds in blocks: each task gives the
sum of its Yᵀ(Yw), and Spark adds them up. The solver on the driver keeps a basis of a bounded number of vectors, takes Ritz
pairs from it, and widens it by corrections: MINRES solves the projected equation of each pair that isn't done, all pairs in step, so that a step is
one pass for all of them. Pairs whose residual has reached the rounding of double precision are locked and leave the basis.

The fit is exact where it can be: entries are whole numbers, sums are whole numbers, and n·x - S is formed before anything is rounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_packed, packed, shared_dir

SCALE, SHIFT = 1024, 100_000
#: Entries beyond this could not be told apart once scaled.
LARGEST = float(1 << 42)
BLOCK_BYTES, PARTITION_BYTES = 1 << 20, 64 << 20
EPS = float(np.finfo("f8").eps)


def usable(vectors: DataFrame) -> DataFrame:
    """``row`` and ``v`` (array of doubles) of rows that take part: see ``whiten``."""
    v = F.col("row.embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > LARGEST))
    rows = packed(vectors).select("row", v.alias("v")).where(v.isNotNull() & ~bad & (F.size(v) > 0))
    most = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    return rows.where(F.size("v") == (most.dim if most else 0))


def whole(batch: pa.RecordBatch) -> np.ndarray:
    """The entries as whole numbers, a row for each vector."""
    v = batch.column("v")
    return np.floor(SCALE * v.flatten().to_numpy(zero_copy_only=False)).astype("i8").reshape(batch.num_rows, -1) + SHIFT


@dataclass
class Whitening:
    """n vectors with sums ``total``; unit eigenvectors (columns) and eigenvalues, largest first; the trace; the error of the whitened covariance."""

    n: int
    total: list[int]
    wide: bool
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    trace: float = 0.0
    identity_error: float = 0.0
    passes: int = 0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n·x - S, exact: whole numbers of 64 bits, or of any size where those might not do."""
        if self.wide:
            return x.astype(object) * self.n - np.array(self.total, object)
        return x * self.n - np.array(self.total, "i8")

    def deviation(self, c: np.ndarray) -> list[int | None]:
        """Sums of squares; None where 64 bits don't hold one."""
        if not self.wide and c.size and float(np.abs(c).max()) ** 2 * c.shape[1] < 2.0**62:
            return (c * c).sum(1).tolist()
        sums = (c.astype(object) ** 2).sum(1).tolist() if c.size else []
        return [s if s < 1 << 63 else None for s in sums]


def totals(rows: DataFrame) -> Whitening | None:
    """Number of vectors and sums of each dimension, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, top = 0, None, 0
        for b in batches:
            if b.num_rows:
                x = whole(b)
                high = int(np.abs(x).max())
                own = x.sum(0) if high * len(x) < 1 << 62 else x.astype(object).sum(0)
                s = [int(a) + int(c) for a, c in zip(s or [0] * x.shape[1], own, strict=True)]
                n, top = n + len(x), max(top, high)
        if n:
            yield pa.RecordBatch.from_pydict({"at": list(range(len(s))), "n": [n] * len(s), "s": list(map(str, s)), "top": [top] * len(s)})

    found = rows.select("v").mapInArrow(run, "at long, n long, s string, top long").groupBy("at")
    found = found.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.max("top").alias("top")).orderBy("at").collect()
    if not found:
        return None
    n = found[0].n
    return Whitening(n, [int(r.s) for r in found], wide=2 * n * max(r.top for r in found) >= 1 << 62)


def blocks(rows: DataFrame, fit: Whitening) -> DataFrame:
    """The centred vectors as doubles, some to a row, in a table in the shared folder, in partitions of a bounded size."""
    dim = len(fit.total)
    each = max(1, BLOCK_BYTES // (8 * dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def full(at_least: int) -> Iterator[pa.RecordBatch]:
            if sum(map(len, held)) >= at_least:
                y = np.concatenate(held)
                held.clear()
                for k in range(0, len(y) - len(y) % each if at_least > 1 else len(y), each):
                    yield pa.RecordBatch.from_pydict({"y": [y[k : k + each].tobytes()]})
                if at_least > 1 and len(y) % each:
                    held.append(y[len(y) - len(y) % each :])

        for b in batches:
            if b.num_rows:
                held.append(fit.centred(whole(b)).astype("f8") / fit.n)
                yield from full(each)
        yield from full(1)

    spark = rows.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, -(-fit.n * dim * 8 // PARTITION_BYTES))
    at = shared_dir(spark)
    rows.select("v").coalesce(parts).mapInArrow(run, "y binary").write.parquet(at)
    return spark.read.parquet(at).coalesce(parts)


def summed(held: DataFrame, dim: int, shape: tuple[int, int], of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """One pass: the sum of ``of(block)`` over all blocks. A task sends the numbers of one result, Spark adds up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            for y in b.column("y"):
                total += of(np.frombuffer(y.as_buffer(), "f8").reshape(-1, dim))
        yield pa.RecordBatch.from_pydict({"at": np.arange(total.size), "value": total.ravel()})

    out = np.zeros(shape[0] * shape[1])
    for r in held.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[r.at] = r.value
    return out.reshape(shape)


def norms(a: np.ndarray) -> np.ndarray:
    return np.sqrt((a * a).sum(0))


def minres(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Solve ``product(x) = right`` for each column by itself, all in step; a column that is done stands still."""
    first = norms(right)
    live = first > 0
    v, eta = right / np.where(live, first, 1), first.copy()
    before, beta = np.zeros_like(v), np.zeros(len(first))
    x, w, w_before = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    c, s, c_before, s_before = np.ones_like(eta), np.zeros_like(eta), np.ones_like(eta), np.zeros_like(eta)
    for _ in range(steps):
        if not live.any():
            break
        p = np.zeros_like(v)
        p[:, live] = product(v, live)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta * before
        beta_next = norms(p)
        delta, second, third = c * alpha - c_before * s * beta, s * alpha + c_before * c * beta, s_before * beta
        rho = np.hypot(delta, beta_next)
        live &= rho > 0
        rho = np.where(rho > 0, rho, 1)
        c_before, s_before = c, s
        c, s = delta / rho, beta_next / rho
        w, w_before = (v - third * w_before - second * w) / rho, w
        x[:, live] += (c * eta * w)[:, live]
        eta = np.where(live, -s * eta, eta)
        live &= (np.abs(eta) > tolerance * first) & (beta_next > EPS * np.abs(alpha))
        before, v, beta = v, p / np.where(beta_next > 0, beta_next, 1), beta_next
    return x


def widen(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Unit vectors of what ``new`` adds to the orthonormal columns ``against``."""
    out = np.zeros((len(new), 0))
    for k in range(new.shape[1]):
        u = new[:, k]
        size = np.linalg.norm(u)
        for _ in range(3):
            for a in (*against, out):
                u = u - a @ (a.T @ u)
            if not (now := np.linalg.norm(u)) > 1e-10 * size:
                break
            u = u / now
            size = 1.0
        else:
            out = np.column_stack([out, u])
    return out


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, inner: int = 5, most: int = 96, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenpairs of a symmetric operator that is known by its products with columns alone."""
    wanted, most = min(wanted, dim), min(dim, max(most, 4 * wanted))
    chance = np.random.default_rng(0)
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    basis = widen(chance.standard_normal((dim, min(dim, 2 * wanted))))
    images = product(basis)
    for _ in range(rounds):
        theta, turn = np.linalg.eigh((basis.T @ images + images.T @ basis) / 2)
        turn = turn[:, ::-1]
        theta = theta[::-1]
        basis, images = basis @ turn, images @ turn
        if basis.shape[1] + len(values) > most:  # start anew from the best
            keep = max(1, min(basis.shape[1], 3 * wanted))
            basis, images, theta = basis[:, :keep], images[:, :keep], theta[:keep]
        rest = wanted - len(values)
        left = images[:, :rest] - basis[:, :rest] * theta[:rest]
        left = left - locked @ (locked.T @ left)
        rounding = 64 * EPS * max(np.abs(theta).max(), np.abs(values).max(initial=0)) * max(1.0, dim**0.5 / 8)
        if basis.shape[1] + len(values) == dim:  # the basis is the whole space: nothing can be added
            rounding = np.inf
        done = int(np.argmin([*(norms(left) <= rounding), False]))
        if done:
            locked, values = np.column_stack([locked, basis[:, :done]]), np.concatenate([values, theta[:done]])
            basis, images, theta, left = basis[:, done:], images[:, done:], theta[done:], left[:, done:]
        if len(values) == wanted:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        some = basis[:, : left.shape[1]]
        shift = theta[: left.shape[1]]

        def apart(z: np.ndarray, live: np.ndarray, some: np.ndarray = some, locked: np.ndarray = locked) -> np.ndarray:
            z = z - locked @ (locked.T @ z)
            return z - some[:, live] * (some[:, live] * z).sum(0)

        def corrected(z: np.ndarray, live: np.ndarray, shift: np.ndarray = shift, apart: Callable = apart) -> np.ndarray:
            z = apart(z[:, live], live)
            return apart(product(z) - shift[live] * z, live)

        every = np.ones(left.shape[1], bool)
        step = minres(corrected, -apart(left, every), inner, 0.05)
        new = widen(apart(step, every), locked, basis)
        if not new.shape[1]:
            new = widen(chance.standard_normal((dim, 1)), locked, basis)
        new = new[:, : dim - len(values) - basis.shape[1]]
        basis, images = np.column_stack([basis, new]), np.column_stack([images, product(new)])
    raise ArithmeticError(f"{len(values)} of {wanted} eigenpairs after {rounds} rounds")


def learn_whitening(vectors: DataFrame, components: int = 8) -> Whitening | None:
    """Fit on all usable vectors (see ``whiten``); None if there is none.

    Components whose eigenvalue is zero but for rounding (below 10^-12 of the trace) can't be whitened and are left out: a table of one
    vector, or of equal vectors, has no components.
    """
    rows = usable(vectors)
    fit = totals(rows)
    if fit is None:
        return None
    n, dim = fit.n, len(fit.total)
    held = blocks(rows, fit).persist(StorageLevel.MEMORY_AND_DISK)

    def product(w: np.ndarray) -> np.ndarray:
        fit.passes += 1
        return summed(held, dim, w.shape, lambda y: y.T @ (y @ w)) / n

    fit.trace = float(summed(held, dim, (1, dim), lambda y: (y * y).sum(0)[None]).sum()) / n
    if fit.trace > 0:
        values, found = jacobi_davidson(product, dim, components)
        real = values > 1e-12 * fit.trace
        fit.values, fit.vectors = values[real], found[:, real]
        w = fit.vectors / np.sqrt(fit.values)
        k = w.shape[1]
        mean = summed(held, dim, (1, k), lambda y: (y @ w).sum(0)[None]) / n
        cov = summed(held, dim, (k, k), lambda y: (y @ w - mean).T @ (y @ w - mean)) / n
        fit.identity_error = float(np.abs(cov - np.eye(k)).max())
    held.unpersist()
    return fit


def whiten(vectors: DataFrame, fit: Whitening) -> DataFrame:
    """Usable rows of ``vectors`` (column embedding) as ``row``, and ``out``: deviation, whitened (array, a number for each component).

    Rows take part whose vector is not null or empty, holds no null or non-finite entry and none beyond 2^42, and has the dimension that
    most of these have (the larger on a tie); they keep all columns. An entry c counts as x = floor(1024 c) + 100000.
    deviation: sum of (n x - S)^2, null where 64 bits don't hold it. Rows that repeat, or have no identifier, count each by itself.
    """
    rows = usable(vectors)
    told = rows.sparkSession.sparkContext.broadcast(fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = told.value.vectors / np.sqrt(told.value.values)
        for b in batches:
            if not b.num_rows:
                continue
            c = told.value.centred(whole(b))
            z = (c.astype("f8") / told.value.n) @ w
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32()), pa.array(z.ravel()))
            out = pa.StructArray.from_arrays([pa.array(told.value.deviation(c), pa.int64()), lists], ["deviation", "whitened"])
            yield pa.RecordBatch.from_arrays([b.column("row"), out], ["row", "out"])

    return map_packed(rows, run, "struct<deviation: long, whitened: array<double>>")


def whitened_rows(vectors: DataFrame, components: int = 8) -> DataFrame:
    """A row for each usable vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    See ``whiten`` and ``learn_whitening``; a table without usable vectors, or without components, gives no rows.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    vectors = vectors.select("vec_id", "embedding")
    fit = learn_whitening(vectors, components)
    if fit is None or not len(fit.values):
        return vectors.sparkSession.createDataFrame([], schema)
    out = whiten(vectors, fit).select("row.vec_id", "out.deviation", F.posexplode("out.whitened").alias("at", "whitened"))
    share = F.element_at(F.array(*(F.lit(float(e / fit.trace)) for e in fit.values)), F.col("at") + 1)
    return out.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(fit.identity_error).alias("identity_error")
    )
