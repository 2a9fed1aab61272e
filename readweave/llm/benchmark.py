"""Benchmark decontamination by Wu-Manber multi-pattern search (operator 11).

A pattern is a window of words of a benchmark item. Texts become their words with one space between, as bytes; cumulative sums of
powers give the hash of any run of words in one step. For each length of window there is a set of tables: the shift table says by how many
words the search may jump after a block of words (two or three), the buckets of those that allow no jump are keyed by the hashes of a
window's last and first block, and a comparison of bytes decides. A worker moves many stretches of text at once, so that a jump costs
a few array operations for thousands of them.

Windows are dealt into sets of bounded size; there is one for any usual benchmark, and its tables are broadcast. Further
sets go over the documents one after another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import inside, lay, map_packed, packed, shared_dir, slices

#: What each byte of UTF-8 becomes: a letter in small form, a digit, a byte of a longer character, or a space.
BYTES = np.full(256, 0x20, "u1")
for low, high in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    BYTES[low:high] = np.arange(low, high)
BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)

WEIGHT = np.random.default_rng(11).integers(1, 1 << 63, 256, "u8") * np.uint64(2) + np.uint64(1)
POWER, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
PIECE, STRETCH, SALTS = 2_000_000, 256, 16
#: So many windows or more take blocks of three words.
WIDE = 50_000


class Powers:
    """Powers of POWER and of its inverse modulo 2^64, as far as they were asked for."""

    up = down = np.zeros(0, "u8")

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            inverse = np.uint64(pow(int(POWER), -1, 1 << 64))
            cls.up, cls.down = (np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(n, x)])) for x in (POWER, inverse))
        return cls.up[:n], cls.down[:n]


class Stream:
    """The words of some texts: their bytes one after another, where each starts and ends, and the first word of each text."""

    def __init__(self, raw: np.ndarray, cuts: np.ndarray) -> None:
        n, small = len(raw), BYTES[raw]
        word, edge = small != 0x20, np.zeros(len(raw) + 1, bool)
        edge[cuts] = True
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        start = np.flatnonzero(word & (~before | edge[:n]))
        end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.bytes = small[word | before]
        parted = np.zeros(len(start), "i8")  # a space stands behind the word
        inner = end < n
        parted[inner] = ~word[end[inner]]
        size = end - start
        self.start = np.cumsum(size + parted) - size - parted
        self.end = self.start + size
        self.first = np.searchsorted(start, cuts)
        up, self.down = Powers.to(len(self.bytes) + 1)
        self.sums = np.zeros(len(self.bytes) + 1, "u8")
        np.cumsum(WEIGHT[self.bytes] * up[:-1], out=self.sums[1:])

    def hash(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of the words from ``first`` to ``last``, both included."""
        begin = self.start[first]
        return (self.sums[self.end[last]] - self.sums[begin]) * self.down[begin] * SPREAD

    @classmethod
    def of(cls, texts: pa.Array) -> Stream:
        offsets = np.frombuffer(texts.buffers()[1], "i4", len(texts) + 1, 4 * texts.offset) if len(texts) else np.zeros(1, "i4")
        raw = np.frombuffer(texts.buffers()[2] or b"", "u1")[offsets[0] : offsets[-1]]
        return cls(raw, (offsets - offsets[0]).astype("i8"))


@dataclass
class Tables:
    """Shift table and buckets for windows of one length in words."""

    words: int
    block: int
    bits: int
    shift: np.ndarray
    key: np.ndarray
    pattern: np.ndarray

    @classmethod
    def build(cls, s: Stream, pattern: np.ndarray, words: int) -> Tables:
        """``pattern``: those texts of ``s`` that have so many words."""
        first = s.first[pattern]
        # As blocks get longer with the number of windows, most still allow a jump.
        block = min(words, 2 if len(pattern) < WIDE else 3)
        bits = max(10, int(len(pattern) * words * 8).bit_length())
        shift = np.full(1 << bits, words - block + 1, "i8")
        for at in range(words - block + 1):
            slot = s.hash(first + at, first + at + block - 1) >> np.uint64(64 - bits)
            np.minimum.at(shift, slot, words - block - at)
        key = both(s.hash(first + words - block, first + words - 1), s.hash(first, first + block - 1))
        order = np.argsort(key, kind="stable")
        return cls(words, block, bits, shift.astype("u1" if words < 256 else "i4"), key[order], pattern[order])

    def candidates(self, s: Stream) -> tuple[np.ndarray, np.ndarray]:
        """Last words and patterns of windows whose buckets fit."""
        reach = np.diff(s.first) - self.words + 1  # last words of windows in each text
        lanes = np.maximum(-(-reach // STRETCH), 0)
        text = np.repeat(np.arange(len(lanes)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = s.first[text] + self.words - 1 + nth * STRETCH
        stop = np.minimum(at + STRETCH, s.first[text + 1])
        ends, found = [np.zeros(0, "i8")], [np.zeros(0, "i8")]
        while len(at):
            suffix = s.hash(at - self.block + 1, at)
            jump = self.shift[suffix >> np.uint64(64 - self.bits)].astype("i8")
            still = jump == 0
            if still.any():
                here = at[still]
                key = both(suffix[still], s.hash(here - self.words + 1, here - self.words + self.block))
                low, high = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
                n = high - low
                ends.append(np.repeat(here, n))
                found.append(self.pattern[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())])
            at = at + np.maximum(jump, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        return np.concatenate(ends), np.concatenate(found)


def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a ^ ((b << np.uint64(31)) | (b >> np.uint64(33)))


class Search:
    """The windows of a set (different ``texts``, words with one space between) and the items that hold them."""

    def __init__(self, texts: pa.Array, begin: np.ndarray, held: np.ndarray, items: list[str]) -> None:
        """``held[begin[k] : begin[k + 1]]``: numbers of the ``items`` (sorted) that hold window k."""
        self.s, self.begin, self.held, self.items = Stream.of(texts), begin, held, items
        words = np.diff(self.s.first)
        self.tables = [Tables.build(self.s, np.flatnonzero(words == m), int(m)) for m in np.unique(words)]

    def equal(self, s: Stream, first: np.ndarray, last: np.ndarray, pattern: np.ndarray) -> np.ndarray:
        """Whether the words from ``first`` to ``last`` are those of the pattern, byte by byte."""
        low, size = s.start[first], s.end[last] - s.start[first]
        own = self.s.start[self.s.first[pattern]]
        same = self.s.end[self.s.first[pattern + 1] - 1] - own == size
        for k in range(0, len(same), 20_000):
            at = k + np.flatnonzero(same[k : k + 20_000])
            if len(at):
                ends = np.arange(len(at) + 1)
                a, total = lay(s.bytes, low[at], size[at], ends)
                b, _ = lay(self.s.bytes, own[at], size[at], ends)
                same[at] = np.logical_and.reduceat(a == b, total[:-1])
        return same

    def windows(self, s: Stream) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words, numbers of words and patterns of all windows that occur."""
        out = [(np.zeros(0, "i8"),) * 3]
        for t in self.tables:
            last, pattern = t.candidates(s)
            first = last - t.words + 1
            real = self.equal(s, first, last, pattern)
            out.append((first[real], np.full(int(real.sum()), t.words), pattern[real]))
        return tuple(map(np.concatenate, zip(*out, strict=True)))

    def long(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """The same for one huge text, a piece at a time, and its number of words: the words before a piece that a window may need come along."""
        most = max((t.words for t in self.tables), default=1) - 1
        out, before, words, at = [(np.zeros(0, "i8"),) * 3], np.zeros(0, "u1"), 0, 0
        while at < len(raw):
            end, step = at + PIECE, PIECE
            while end < len(raw):  # a piece ends where a word does
                spaces = np.flatnonzero(BYTES[raw[end - step : end]] == 0x20)
                if len(spaces):
                    end += int(spaces[-1]) + 1 - step
                    break
                end += step
            piece = np.concatenate([before, np.full(1, 0x20, "u1"), raw[at:end]])
            s = Stream(piece, np.array([0, len(piece)]))
            came = len(Stream(before, np.array([0, len(before)])).start)
            first, size, pattern = self.windows(s)
            out.append((first + words - came, size, pattern))
            words, n = words + len(s.start) - came, min(most, len(s.start))
            before, at = (s.bytes[s.start[-n] :] if n else before[:0]), end
        return *map(np.concatenate, zip(*out, strict=True)), words

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Of each text: number of words, runs of words inside windows (first, end), and the items that occur."""
        huge = len(texts) == 1 and (texts.nbytes > 2 * PIECE)
        if huge:
            s = None
            raw = np.frombuffer(texts[0].as_buffer(), "u1")
            first, size, pattern, words = self.long(raw)
            cuts = np.array([0, words])
        else:
            s = Stream.of(texts)
            cuts = s.first
            first, size, pattern = self.windows(s)
        n = int(cuts[-1])
        depth = np.bincount(first, minlength=n + 1) - np.bincount(first + size, minlength=n + 1)
        hit = np.cumsum(depth)[:n] > 0
        edge, before, after = np.zeros(n + 1, bool), np.zeros(n, bool), np.zeros(n, bool)
        edge[cuts] = True
        before[1:], after[:-1] = hit[:-1], hit[1:]
        begin, end = np.flatnonzero(hit & (~before | edge[:n])), np.flatnonzero(hit & (~after | edge[1:])) + 1
        text = np.searchsorted(cuts, begin, "right") - 1
        runs = pa.StructArray.from_arrays([pa.array((x - cuts[text]), pa.int64()) for x in (begin, end)], ["first", "end"])
        spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(begin, cuts), pa.int32()), runs)
        text = np.searchsorted(cuts, first, "right") - 1
        text, pattern = np.unique(np.stack([text, pattern]), axis=1) if len(first) else (first, pattern)
        many = self.begin[pattern + 1] - self.begin[pattern]
        item = self.held[np.repeat(self.begin[pattern] - np.cumsum(many) + many, many) + np.arange(many.sum())]
        pairs = np.unique(np.repeat(text, many) * max(1, len(self.items)) + item)
        ends = np.searchsorted(pairs, np.arange(len(texts) + 1) * max(1, len(self.items)))
        names = pa.array(self.items, pa.string()).take(pa.array(pairs % max(1, len(self.items)), pa.int64()))
        return np.diff(cuts), spans, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), names)


def words_of(text: Column) -> Column:
    """The words as an array; a null text has none."""
    small = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(small, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def windows(benchmark: DataFrame, size: int = 10) -> DataFrame:
    """window (``size`` words with a space between; all words of an item that has fewer) and item (its identifier as text), each pair once."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(size - 1), F.lit(1)))
    return w.select("item", "w", F.explode(starts).alias("at")).select(F.array_join(F.slice("w", F.col("at"), size), " ").alias("window"), "item").distinct()


def search_for(pairs: pa.Table) -> Search:
    """From windows and items, a bounded set; windows of items without an identifier mark words alone."""
    window = pairs["window"].combine_chunks().dictionary_encode()
    items = sorted({x for x in pairs["item"].to_pylist() if x is not None})
    number = {x: k for k, x in enumerate(items)}
    at, item = window.indices.to_numpy(), np.array([number.get(x, -1) for x in pairs["item"].to_pylist()], "i8")
    at, item = at[item >= 0], item[item >= 0]
    order = np.argsort(at, kind="stable")
    begin = np.searchsorted(at[order], np.arange(len(window.dictionary) + 1))
    return Search(window.dictionary.cast(pa.string()), begin, item[order], items)


FOUND = "struct<n_words: long, spans: array<struct<first: long, end: long>>, items: array<string>>"


def find_items(docs: DataFrame, benchmark: DataFrame, size: int = 10, most: int = 400_000) -> DataFrame:
    """Each row of ``docs`` (column text) as ``row``, and ``out``: n_words, spans, items.

    spans: runs of words, counted from 0, that lie inside an occurrence of a window (first, end; runs that touch are one); items: the
    item_ids, as text and sorted, with a window that occurs. Words are runs of letters and digits of ASCII and of all other
    characters, A-Z lower-cased; null and empty texts have none. Items without words give no window, those with fewer than
    ``size`` words one; items that share an item_id are one, and those without one mark words but are not listed. Rows that repeat are
    judged alike. An empty table of documents gives an empty table, an empty benchmark hits nothing.

    ``most``: windows (with their items) of a set, whose tables (some 150 bytes each) are broadcast; what is more goes over the documents in
    further sets, whose finds, rows with hits alone, are put together by text.
    """
    spark = docs.sparkSession
    pairs = windows(benchmark, size)
    where = shared_dir(spark)
    pairs.write.parquet(where)
    pairs = spark.read.parquet(where)
    sets = max(1, -(-pairs.count() // most))
    rows, take = packed(docs), inside(docs, "text")

    def run(dealt: DataFrame) -> DataFrame:
        told = spark.sparkContext.broadcast(search_for(dealt.select("window", "item").toArrow()))

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for start, end, texts in slices(take(b), size=PIECE):
                    n, spans, items = told.value.texts(texts)
                    out = pa.StructArray.from_arrays([pa.array(n, pa.int64()), spans, items], ["n_words", "spans", "items"])
                    yield pa.RecordBatch.from_arrays([b.column("row").slice(start, end - start), out], ["row", "out"])

        return map_packed(rows, look, FOUND)

    if sets == 1:
        return run(pairs)
    dealt = pairs.withColumn("nth", F.pmod(F.xxhash64("window", "item"), F.lit(sets)))
    text = F.sha2(F.coalesce(F.col("row.text"), F.lit("")), 256)
    parts = None
    for k in range(sets):
        part = run(dealt.where(F.col("nth") == k)).where(F.size("out.spans") > 0).select(text.alias("sha"), F.lit(k).alias("nth"), "out")
        part = part.groupBy("sha", "nth").agg(F.first("out").alias("out"), F.count(F.lit(1)).alias("n"))
        at = shared_dir(spark)
        part.write.parquet(at)
        part = spark.read.parquet(at)
        parts = part if parts is None else parts.unionByName(part)
    one = parts.groupBy("sha").agg(F.flatten(F.collect_list("out.spans")).alias("spans"), F.flatten(F.collect_list("out.items")).alias("items"))
    one = one.select("sha", merged("spans").alias("spans"), F.array_sort(F.array_distinct("items")).alias("items"))
    # Many rows may hold one text, so the few texts with hits are sent to each of SALTS places.
    one = one.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    counted = rows.select("row", text.alias("sha"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"))
    n = F.size(words_of(F.col("row.text"))).cast("long").alias("n_words")
    spans = F.coalesce("spans", F.array().cast("array<struct<first: bigint, end: bigint>>")).alias("spans")
    return counted.join(one, ["sha", "salt"], "left").select("row", F.struct(n, spans, F.coalesce("items", F.array().cast("array<string>")).alias("items")).alias("out"))


def merged(spans: str) -> Column:
    """Sorted spans; those that overlap or touch are one."""
    nothing = F.array().cast("array<struct<first: bigint, end: bigint>>")

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.struct(last["first"].alias("first"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (last["end"] >= x["first"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), nothing, add)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, most: int = 400_000) -> DataFrame:
    """doc_id, n_words, n_hit (words inside windows), n_items, items_sha256 (of the sorted item_ids with commas), contaminated; see ``find_items``."""
    out = find_items(docs.select("doc_id", "text"), benchmark, size, most)
    hit = F.aggregate("out.spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    out = out.select("row.doc_id", "out.n_words", hit.alias("n_hit"), F.size("out.items").cast("long").alias("n_items"), F.sha2(F.array_join("out.items", ","), 256).alias("items_sha256"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10, share: float = 0.0) -> DataFrame:
    """Rows of ``docs``, with all their columns, of which no more than ``share`` of the words lie inside windows; see ``find_items``."""
    out = find_items(docs, benchmark, size)
    hit = F.aggregate("out.spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    return out.where(hit <= F.col("out.n_words") * share).select("row.*")

