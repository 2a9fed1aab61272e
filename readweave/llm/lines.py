"""Line dedup by winnowing over line hashes (operator 7).

A gram is the shortest run of lines from a line on that holds ``gram_words`` words; a window is the
shortest run that holds ``min_words``. Of the grams inside a window the one with the least hash is
chosen, the later one on a tie. A fingerprint is the hash of a window together with that gram: of the shortest window from each line on, and
of the shortest one back from each line. Every line of a run of ``min_words`` words or more lies in such a window inside the run.

Fingerprints meet by hash, and each occurrence is paired with the earliest one alone, never with all: as the whole window is equal
there, a repeat is found whatever surrounds the earliest place of its grams. A pair is
extended both ways, by halving over hashes of runs of lines; if the run has ``min_words`` words, its lines are deleted in the
later place. The earliest place of every line always stays.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .benchmark import SPREAD, Powers
from .common import HOT, checkpointed, hot_join, map_packed, packed


def line_hashes(text: str) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(line) for line in text.split("\n")], "u8").view("i8")


def winnow(hashes: np.ndarray, words: list[int], min_words: int, gram_words: int) -> list[tuple[int, int]]:
    """Fingerprints of a text: (hash of a window and its gram, first line of the window)."""
    n, total = len(words), np.concatenate([[0], np.cumsum(words)])
    if total[-1] < min_words:
        return []
    raw = hashes.tobytes()
    gram_end = np.searchsorted(total, total[:-1] + gram_words)  # line after the gram
    window_end = np.searchsorted(total, total[:-1] + min_words)
    window_start = np.searchsorted(total, total[1:] - min_words, "right") - 1  # of the window that ends with the line
    chosen, held, j = [], deque(), 0
    for i in range(n):
        if window_end[i] > n:
            break
        while j < n and gram_end[j] <= window_end[i]:
            h = xxhash.xxh64_intdigest(raw[8 * j : 8 * int(gram_end[j])])
            while held and held[-1][0] >= h:
                held.pop()
            held.append((h, j))
            j += 1
        while held[0][1] < i:
            held.popleft()
        chosen.append(held[0][0])
    spans = {(i, int(window_end[i])) for i in range(len(chosen))} | {(int(i), end + 1) for end, i in enumerate(window_start) if i >= 0}
    found = ((xxhash.xxh64_intdigest(raw[8 * i : 8 * end], chosen[i]), i) for i, end in sorted(spans))
    return [(h - (1 << 64) if h >= 1 << 63 else h, at) for h, at in found]


def line_table(docs: DataFrame, min_words: int, gram_words: int) -> DataFrame:
    """did, uid (which row), lines (hashes), words (of each line), marks (array of hash and line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines, words, marks = [], [], []
            for t in b.column("text"):
                t = t.as_py()
                lines.append(line_hashes(t))
                words.append([len(x.split()) for x in t.split("\n")])
                marks.append([{"h": m, "pos": at} for m, at in winnow(lines[-1], words[-1], min_words, gram_words)])
            yield pa.RecordBatch.from_arrays(
                [b.column("did"), b.column("uid"), pa.array(lines, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.int32())), pa.array(marks, pa.list_(pa.struct([("h", pa.int64()), ("pos", pa.int32())])))],
                ["did", "uid", "lines", "words", "marks"],
            )

    return docs.mapInArrow(run, "did long, uid long, lines array<long>, words array<int>, marks array<struct<h:long,pos:int>>")


def sums(hashes: np.ndarray) -> np.ndarray:
    """Running sums of hashes times powers: from them follows a hash of any run of lines."""
    up, _ = Powers.to(len(hashes) + 1)
    return np.concatenate([np.zeros(1, "u8"), np.cumsum(hashes.view("u8") * SPREAD * up[1:])])


def common_length(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, most: np.ndarray, ahead: bool) -> np.ndarray:
    """How many lines agree from line i of one text and line j of another on (or back from before them), ``most`` at most: found by halving."""
    _, down = Powers.to(max(len(a), len(b)))
    low, high = np.zeros_like(most), most.copy()
    while (low < high).any():
        mid = (low + high + 1) // 2
        x, y = (i, j) if ahead else (i - mid, j - mid)
        same = (a[x + mid] - a[x]) * down[x] == (b[y + mid] - b[y]) * down[y]
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def repeated(own: np.ndarray, words: np.ndarray, theirs: np.ndarray, pos: np.ndarray, off: np.ndarray, min_words: int) -> np.ndarray:
    """Lines of a text that repeat another one: line ``pos`` stands against line ``pos + off``, and runs are extended both ways from there.

    Takes the logarithm of the lines for each such place, whatever the runs' lengths.
    """
    a, b, at = sums(own), sums(theirs), pos + off
    hi = pos + common_length(a, pos, b, at, np.minimum(len(own) - pos, len(theirs) - at), True)
    lo = pos - common_length(a, pos, b, at, np.minimum(pos, at), False)
    total = np.concatenate([[0], np.cumsum(words)])
    enough = total[hi] - total[lo] >= min_words
    depth = np.bincount(lo[enough], minlength=len(own) + 1) - np.bincount(hi[enough], minlength=len(own) + 1)
    return np.flatnonzero(np.cumsum(depth)[:-1] > 0)


def repeated_lines(pairs: DataFrame, min_words: int) -> DataFrame:
    """did, uid, gone (lines that go), a row for each pair of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            gone = []
            for own, words, theirs, at in zip(*(b.column(c) for c in ("lines", "words", "theirs", "at")), strict=True):
                pos, off = (x.to_numpy().astype("i8") for x in at.values.flatten())
                gone.append(repeated(own.values.to_numpy(), words.values.to_numpy(), theirs.values.to_numpy(), pos, off, min_words))
            yield pa.RecordBatch.from_arrays([b.column("did"), b.column("uid"), pa.array(gone, pa.list_(pa.int32()))], ["did", "uid", "gone"])

    return pairs.mapInArrow(run, "did long, uid long, gone array<int>")


#: A text that more than one of HOT pairs compares with is dealt into so many parts.
SALTS = 64


def dedup_lines(docs: DataFrame, min_words: int = 50, gram_words: int = 25, n_lines: str = "n_lines", n_removed: str = "n_removed") -> DataFrame:
    """The rows of ``docs`` with later repeated runs of lines taken out of ``text``; n_lines and n_removed are added.

    Lines end at line feeds and must be equal byte for byte; words stand between white space. Earlier means a smaller
    doc_id (nulls first), then a smaller hash of the text, then an earlier line, so that runs that repeat inside a text
    go too. Rows that repeat doc_id and text are one document. A null text counts as empty and comes out
    empty; it has one line. Texts below ``min_words`` words are left alone. Columns named as ``n_lines`` or ``n_removed`` say are
    replaced, all others kept, whatever their names; an empty table gives an empty table.
    """
    docs = docs.drop(n_lines, n_removed).withColumn("text", F.coalesce("text", F.lit("")))
    keyed = packed(docs, F.coalesce("doc_id", F.lit(-(1 << 63))).alias("did"), F.xxhash64("doc_id", "text").alias("uid"))
    lines = checkpointed(line_table(keyed.select("did", "uid", F.col("row.text").alias("text")), min_words, gram_words))
    marks = lines.select("did", "uid", F.inline("marks"))
    here = F.struct("did", "uid", "pos")
    first = marks.groupBy("h").agg(F.min(here).alias("o"), F.max(here).alias("last"), F.count(F.lit(1)).alias("n")).where("o != last").drop("last")
    first, total = checkpointed(first), marks.count()
    hits = hot_join(marks, first, "h", total).where(here != F.col("o"))
    # One row for each pair of texts, with all places that meet and the shift between their lines.
    place = F.struct("pos", (F.col("o.pos") - F.col("pos")).alias("off"))
    shift = hits.groupBy("did", "uid", F.col("o.did").alias("odid"), F.col("o.uid").alias("ouid")).agg(F.collect_set(place).alias("at"))
    shift = checkpointed(shift)
    # A text that many others repeat: fewer than HOT of them, two numbers each, are broadcast, and their rows salted.
    hot = shift.groupBy("odid", "ouid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * HOT > shift.count())
    hot = F.broadcast(hot.select("odid", "ouid", F.lit(SALTS).alias("salts")))
    asked = shift.join(hot, ["odid", "ouid"], "left").withColumn("salt", F.pmod(F.xxhash64("did", "uid"), F.coalesce("salts", F.lit(1)))).drop("salts")
    texts = lines.select("did", "uid", "lines", "words")
    theirs = lines.select(F.col("did").alias("odid"), F.col("uid").alias("ouid"), F.col("lines").alias("theirs")).join(shift.select("odid", "ouid").distinct(), ["odid", "ouid"], "left_semi")
    theirs = theirs.dropDuplicates(["odid", "ouid"]).join(hot, ["odid", "ouid"], "left")
    theirs = theirs.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)).cast("long") - 1))).drop("salts")
    pairs = asked.join(theirs, ["odid", "ouid", "salt"]).join(texts.dropDuplicates(["did", "uid"]), ["did", "uid"])
    found = repeated_lines(pairs, min_words).select("did", "uid", F.explode("gone").alias("line")).groupBy("did", "uid").agg(F.collect_set("line").alias("gone"))
    joined = keyed.join(found, ["did", "uid"], "left").select("row", "gone")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, found, removed, texts = b.column("row").flatten(), [], [], []
            for t, gone in zip(row[at].to_pylist(), b.column("gone").to_pylist(), strict=True):
                found.append(t.count("\n") + 1)
                removed.append(len(gone or ()))
                gone = set(gone or ())
                texts.append("\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone) if gone else t)
            row[at] = pa.array(texts, pa.string())
            row = pa.StructArray.from_arrays(row, fields=list(b.column("row").type))
            counts = pa.StructArray.from_arrays([pa.array(found, pa.int64()), pa.array(removed, pa.int64())], ["lines", "removed"])
            yield pa.RecordBatch.from_arrays([row, counts], ["row", "out"])

    return map_packed(joined, run, "struct<lines:long,removed:long>").select("row.*", F.col("out.lines").alias(n_lines), F.col("out.removed").alias(n_removed))
