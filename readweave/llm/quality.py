"""Quality classifier: votes of the nearest labelled documents in a latent space (operator 8).

Whole texts become weighted counts of byte pairs, hashed into a fixed number of features, and one feature made by hand: the share of words that
are said twice running, as repetition is a common sign of poor text that pairs of bytes don't see. A singular value
decomposition of a bounded, labelled sample gives the latent space. The sample's vectors (at most ``per_class`` rows of
each label times ``rank`` numbers, a few MB) are broadcast; every document is compared with all of them in
blocked products, and its nearest neighbours vote with weights that follow similarity. Documents are
scanned once; nothing of them is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import inside, map_packed, packed

FEATURES = 4096
_PAIR = ((np.arange(1 << 16, dtype="u8") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)).astype("u2")


def byte_pairs(raw: bytes) -> np.ndarray:
    """Damped counts of all neighbouring bytes of a text, hashed into FEATURES, and one term for words said twice running."""
    out = np.zeros(FEATURES + 1, "f4")
    b = np.frombuffer(raw, "u1")
    if len(b) < 2:
        return out
    pair = b[:-1].astype("u2") << np.uint16(8) | b[1:]
    out[:-1] = np.sqrt(np.bincount(_PAIR[pair], minlength=FEATURES).astype("f4") / np.float32(len(pair)))
    words = raw.split()
    out[-1] = 2 * sum(map(eq, words, islice(words, 1, None))) / max(1, len(words) - 1)
    return out


@dataclass
class Space:
    """Projection of features, and the sample's unit vectors with labels and votes."""

    weights: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    prior: float

    def project(self, x: np.ndarray) -> np.ndarray:
        z = (x * self.weights) @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def score(self, x: np.ndarray, k: int) -> np.ndarray:
        """Share of label 1 in the votes of the k nearest; the prior where nothing is alike."""
        cosine = self.project(x) @ self.vectors.T
        k = min(k, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype("f8") ** 8 * self.votes[near]
        pull = 1e-6
        return ((w * self.labels[near]).sum(1) + pull * self.prior) / (w.sum(1) + pull)


def fit_space(features: np.ndarray, labels: np.ndarray, prior: float, rank: int) -> Space:
    """The latent space of a sample. ``prior``: share of label 1 among all labelled rows."""
    weights = np.log((1 + len(features)) / (1 + (features > 0).sum(0))).astype("f4") + np.float32(1)
    x = features * weights
    rank = max(1, min(rank, *x.shape))
    rng = np.random.default_rng(0)
    q = x.T @ rng.standard_normal((len(x), rank + 8)).astype("f4")
    for _ in range(4):  # subspace iteration on a bounded sample
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    basis = (q @ v.T)[:, :rank].astype("f4")
    share = labels.mean() if len(labels) else prior
    votes = np.where(labels == 1, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9))
    space = Space(weights, basis, np.zeros((0, rank), "f4"), labels.astype("f8"), votes, prior)
    space.vectors = space.project(features)
    return space


def learn_quality(docs: DataFrame, labels: DataFrame, per_class: int = 1500, rank: int = 64) -> Space | None:
    """Fit on labelled rows of ``docs`` whose crc32(doc_id) mod 3 is not 1; None if there are none.

    The sample is bounded by ``per_class`` rows of each label, those with the least hash of doc_id. A document with labels that
    disagree counts as 0; rows without a label or identifier are left out.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    totals = {r.quality: r.n for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return None
    mark = F.xxhash64("doc_id")
    sample = None
    for q in (0, 1):
        one = known.where(F.col("quality") == q).orderBy(mark, "doc_id").limit(per_class)
        sample = one if sample is None else sample.unionByName(one)
    # At most 2 * per_class rows of two numbers.
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [byte_pairs((t or "").encode()).astype("f2").tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality"), pa.array(x, pa.binary())], ["doc_id", "quality", "x"])

    rows = texts.mapInArrow(run, "doc_id long, quality int, x binary").groupBy("doc_id").agg(F.first("quality").alias("quality"), F.min("x").alias("x")).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: r.doc_id)
    features = np.stack([np.frombuffer(r.x, "f2") for r in rows]).astype("f4")
    return fit_space(features, np.array([r.quality for r in rows]), totals.get(1, 0) / sum(totals.values()), rank)


def score_quality(docs: DataFrame, space: Space | None, k: int = 15, score: str = "score") -> DataFrame:
    """Add ``score`` (0 to 1, higher: label 1 likelier) to the rows of ``docs``.

    The whole text counts. Null and empty texts, and texts of one byte, have no features and get the share of label 1 among
    all labelled rows; without any labels every score is 0.5. A column of the same name is replaced, all others and
    repeated rows come through.
    """
    rows, own = packed(docs.drop(score)), inside(docs.drop(score), "text")
    sent = docs.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = sent.value
        for b in batches:
            text, scores = own(b).column("text"), []
            for start in range(0, b.num_rows, 512):
                x = np.stack([byte_pairs((t.as_py() or "").encode()) for t in text.slice(start, 512)])
                scores.append(np.full(len(x), 0.5) if space is None else np.where(x.any(1), space.score(x, k), space.prior))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["row", "out"])

    return map_packed(rows, run, "double").select("row.*", F.col("out").alias(score))


def judge_quality(docs: DataFrame, labels: DataFrame, per_class: int = 1500, rank: int = 64, k: int = 15) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out (crc32(doc_id) mod 3 is 1; null: false), score, predicted.

    Null and empty texts get the share of label 1; rows that repeat all come out; further columns are not carried; an empty
    table gives an empty table.
    """
    scored = score_quality(docs.select("doc_id", "text"), learn_quality(docs, labels, per_class, rank), k)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
