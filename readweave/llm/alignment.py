"""Alignment of two tokenizers' tokens by diagonal run skipping (operator 13).

Both tokenizers cut the same bytes. Their tokens are compared by the byte offsets at which they end: while both arrays agree at the current
shift between their indexes, slices of doubling length are compared and a stretch of one-to-one groups is passed in a few steps;
where they part, the smaller end moves on until both meet, which closes an irregular group and gives the new shift.

Neither tokenizer joins the two sides of a space or line feed between visible characters (checked on its vocabulary), so texts are cut
there, and each worker aligns every distinct unit once, all new units of a batch as one long stream. Counts of linked ids are sums over all
documents. What each document links is written once, and read again when the counts are known.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import hot_join, lay, shared_dir, slices

SPACE = "▁"
#: Bytes of a stream that is handed to the tokenizers in one call.
STREAM = 100_000


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: visible ones stand for themselves, the rest follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """A byte-level tokenizers file; strings of its special tokens are ordinary text."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.size = np.array(list(map(len, self.bytes)), "i8")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model that adds a space before a text; takes texts that begin with one."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        self.size = np.array(list(map(len, self.bytes)), "i8")
        ordinary = [p for i, p in enumerate(names) if not self.model.is_byte(i)]
        #: No piece holds a space behind anything else, or a line feed: texts may be cut before them.
        self.cuts = not any(SPACE in p.lstrip(SPACE) or ("\n" in p and p != "\n") for p in ordinary)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([t[1:] for t in texts], num_threads=1)


def diagonal(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of ``a`` and of ``b`` that are passed when each group ends; both rise and end on the same number."""
    i, j, n, of_a, of_b = 0, 0, len(a), [], []
    while i < n:
        x, y = a[i], b[j]
        if x == y:  # one to one: how long do both agree at this shift?
            run, step = 1, 1
            while step and i + run < n:
                if a[i + run : i + run + step] == b[j + run : j + run + step]:
                    run += step
                    step *= 2
                else:
                    step //= 2
            run = min(run, n - i)
            of_a.extend(range(i + 1, i + run + 1))
            of_b.extend(range(j + 1, j + run + 1))
            i, j = i + run, j + run
            continue
        while x != y:  # an irregular group: the smaller end moves on
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i, j = i + 1, j + 1
        of_a.append(i)
        of_b.append(j)
    return np.array(of_a, "i8"), np.array(of_b, "i8")


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All numbers of two rising arrays, each once."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    return both[new]


#: Leads of characters that may be white space: no cut stands before them.
LEADS = np.ones(256, bool)
LEADS[:0x21] = LEADS[0x7F] = LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = False


def visible(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a visible character ends at each place; where it is hard to tell it does not."""
    last, lead = raw[at], raw[np.maximum(at - 1, 0)]
    return ((last > 0x20) & (last < 0x7F)) | ((last >= 0x80) & (lead >= 0xC3) & (lead <= 0xDF))


def cut_places(raw: np.ndarray) -> np.ndarray:
    """Places of single spaces and line feeds between visible characters; where it is hard to tell there is none."""
    if len(raw) < 3:
        return np.zeros(0, "i8")
    at = np.flatnonzero((raw[1:-1] == 0x20) | (raw[1:-1] == 0x0A)) + 1
    return at[visible(raw, at - 1) & LEADS[raw[at + 1]]]


def view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (strings or binary), and where each begins (and the last ends)."""
    ends = np.frombuffer(texts.buffers()[1], "i4", len(texts) + 1, 4 * texts.offset).astype("i8") if len(texts) else np.zeros(1, "i8")
    raw = np.frombuffer(texts.buffers()[2] or b"", "u1")[ends[0] : ends[-1]]
    return raw, ends - ends[0]


def strings(kind: pa.DataType, raw: bytes, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(kind, len(ends) - 1, [None, pa.py_buffer(ends.astype("i4").tobytes()), pa.py_buffer(raw)])


@dataclass
class Known:
    """Units and, for each: its groups as text, how many tokens of A, tokens of B and groups it has, and its links as a << 32 | b."""

    words: pa.Array
    groups: pa.Array
    numbers: np.ndarray
    size: np.ndarray
    links: np.ndarray

    @classmethod
    def none(cls) -> Known:
        return cls(pa.array([], pa.string()), pa.array([], pa.binary()), np.zeros((0, 3), "i8"), np.zeros(0, "i8"), np.zeros(0, "u8"))

    def take(self, at: np.ndarray) -> Known:
        links, _ = lay(self.links, (np.cumsum(self.size) - self.size)[at], self.size[at], np.arange(len(at) + 1))
        where = pa.array(at)
        return Known(self.words.take(where), self.groups.take(where), self.numbers[at], self.size[at], links)

    def __add__(self, more: Known) -> Known:
        return Known(
            pa.concat_arrays([self.words, more.words]), pa.concat_arrays([self.groups, more.groups]), np.concatenate([self.numbers, more.numbers]),
            np.concatenate([self.size, more.size]), np.concatenate([self.links, more.links]),
        )

    @property
    def nbytes(self) -> int:
        return self.words.nbytes + self.groups.nbytes + self.numbers.nbytes + self.size.nbytes + self.links.nbytes


def apart(encode: Callable[[list[str]], list[list[int]]]) -> bool:
    """Whether a tokenizer gives the same on both sides of a cut as without it, on samples."""
    for left, right in ((" ab1,", " cd."), (" cd", " ef"), (" gé", " hé."), (" cd.", "\nEf,"), (" cd", "\n12")):
        (whole, first, second) = encode([left + right, left, right if right[0] == " " else " " + right])
        if whole != first + second[right[0] == "\n" :]:
            return False
    return True


class Aligner:
    """Both tokenizers, and a store of known units of about ``most`` bytes."""

    def __init__(self, path_a: str, path_b: str, most: int = 40 << 20) -> None:
        self.a, self.b, self.most, self.known = ByteLevel(path_a), Pieces(path_b), most, Known.none()
        self.cuts = self.b.cuts and all(map(apart, (self.a.encode, self.b.encode)))
        self.names = max(len(self.a.bytes), len(self.b.bytes))
        self.marked = pa.array([b"%d%s" % (n, mark) for mark in (b",", b"|", b";") for n in range(self.names)], pa.binary())

    def align(self, units: pa.Array) -> Known:
        """Units that begin with white space and end visibly are one text in a row, and encoded as streams; the rest one by one."""
        raw, ends = view(units)
        first = raw[ends[:-1]]
        regular = ((first == 0x20) | (first == 0x0A)) & (np.diff(ends) > 1) & LEADS[raw[np.minimum(ends[:-1] + 1, len(raw) - 1)]] & visible(raw, ends[1:] - 1)
        if not self.cuts:
            regular[:] = False
        out, order = Known.none(), np.concatenate([np.flatnonzero(regular), np.flatnonzero(~regular)])
        inside = units.filter(pa.array(regular))
        _, ends = view(inside)
        start, parts = 0, []
        while start < len(inside):
            end = max(start + 1, int(np.searchsorted(ends, ends[start] + STREAM, "right")) - 1)
            parts += self.together(inside.slice(start, end - start))
            start = end
        for k in np.flatnonzero(~regular).tolist():
            parts += self.together(units.slice(k, 1))
        for step in range(0, len(parts), 64):
            out = out + sum(parts[step + 1 : step + 64], parts[step])
        back = np.empty(len(order), "i8")
        back[order] = np.arange(len(order))
        return out.take(back)

    def together(self, units: pa.Array) -> list[Known]:
        """``units`` as one stream. A unit that the tokenizers don't give back has -1 for its numbers."""
        raw, close = view(units)
        raw, close = raw.tobytes(), close[1:]
        lead = b"" if raw[:1] == b" " else b" "  # a unit that begins otherwise follows a space, which is taken off again
        stream = lead + raw
        text = stream.decode()
        (a,), (b,) = self.a.encode([text]), self.b.encode([text])
        if b"".join(map(self.a.bytes.__getitem__, a)) != stream or b"".join(map(self.b.bytes.__getitem__, b)) != stream:
            if len(units) > 1:
                return [x for k in range(len(units)) for x in self.together(units.slice(k, 1))]
            return [Known(units, pa.array([b""], pa.binary()), np.full((1, 3), -1, "i8"), np.zeros(1, "i8"), np.zeros(0, "u8"))]
        a, b = np.array(a, "i8"), np.array(b, "i8")
        ends_a, ends_b = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        if lead:
            if not (len(a) > 1 and ends_a[0] == 1 == ends_b[0]):
                raise ValueError("a space joins what follows it; texts can't be cut at line feeds")
            a, b, ends_a, ends_b = a[1:], b[1:], ends_a[1:] - 1, ends_b[1:] - 1
        of_a, of_b = diagonal(ends_a.tolist(), ends_b.tolist())  # tokens passed at the end of each group
        last = np.searchsorted(ends_a[of_a - 1], close)  # the last group of each unit
        if not np.array_equal(ends_a[of_a[last] - 1], close):
            raise ValueError("a token reaches over a cut")
        # Inside a group each end but the last belongs to one side: a link starts at each end of the other.
        every = merged(ends_a, ends_b)
        pairs = (a[np.searchsorted(ends_a, every)].astype("u8") << np.uint64(32)) | b[np.searchsorted(ends_b, every)].astype("u8")
        said, ends = view(self.marked.take(pa.array(self.written(a, b, of_a, of_b))))
        groups = strings(pa.binary(), said.tobytes(), ends[np.concatenate([[0], (of_a + of_b)[last]])])
        numbers = np.stack([np.diff(x, prepend=0) for x in (of_a[last], of_b[last], last + 1)], axis=1)
        return [Known(units, groups, numbers, np.diff(np.searchsorted(every, close, "right"), prepend=0), pairs)]

    def written(self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> np.ndarray:
        """Tokens group by group, those of A before those of B, as rows of ``marked``: each with the mark that follows it."""
        mine, yours = a.copy(), b.copy()
        mine[of_a - 1] += self.names
        yours[of_b - 1] += 2 * self.names
        shift_a = np.repeat(np.concatenate([[0], of_b[:-1]]), np.diff(of_a, prepend=0))
        shift_b = np.repeat(of_a, np.diff(of_b, prepend=0))
        out = np.empty(len(a) + len(b), "i8")
        out[np.arange(len(a)) + shift_a] = mine
        out[np.arange(len(b)) + shift_b] = yours
        return out

    def find(self, words: pa.Array) -> tuple[np.ndarray, Known]:
        """Where each of ``words`` (all different) stands among known units, those that are new included.

        Beyond ``most`` bytes those stay that these words asked for again: the common ones.
        """
        at = pc.fill_null(pc.index_in(words, value_set=self.known.words), -1).to_numpy(zero_copy_only=False).astype("i8")
        new = np.flatnonzero(at < 0)
        if not len(new):
            return at, self.known
        found = self.align(words.take(pa.array(new)))
        if self.known.nbytes + found.nbytes > self.most:
            again = np.flatnonzero(at >= 0)
            self.known = self.known.take(at[again])
            at[again] = np.arange(len(again))
        at[new] = len(self.known.words) + np.arange(len(new))
        both = self.known + found
        self.known = both if both.nbytes <= self.most else Known.none()
        return at, both

    def documents(self, texts: pa.Array) -> pa.RecordBatch:
        """Of each text n_a, n_b, n_groups, n_links, groups_sha256 and links (a, b, n: how often): zeros if it has no tokens."""
        n = len(texts)
        odd = pc.match_substring(texts, SPACE).to_numpy(zero_copy_only=False) | (pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0)
        texts = pc.if_else(pa.array(odd), "", pc.binary_join_element_wise("", texts, " "))  # a space before each
        raw, offsets = view(texts)
        bounds = merged(cut_places(raw) if self.cuts else np.zeros(0, "i8"), offsets)
        first = np.searchsorted(bounds, offsets)  # the first unit of each text
        coded = strings(pa.string(), raw.tobytes(), bounds).dictionary_encode()
        where, known = self.find(coded.dictionary)
        unit = where[coded.indices.to_numpy()]
        numbers = known.numbers[unit]
        of_unit = np.concatenate([np.zeros((1, 3), "i8"), np.cumsum(np.maximum(numbers, 0), axis=0)])
        bad = np.concatenate([[0], np.cumsum(numbers[:, 0] < 0)])
        odd = odd | (bad[first[1:]] > bad[first[:-1]])
        counts = np.where(odd[:, None], 0, of_unit[first[1:]] - of_unit[first[:-1]])
        told = []
        for start, end in self.runs(known.groups, unit, first):
            said, ends = view(known.groups.take(pa.array(unit[first[start] : first[end]])))
            ends = ends[first[start : end + 1] - first[start]].tolist()
            told += ["" if odd[k] else hashlib.sha256(said[x : y - 1]).hexdigest() for k, x, y in zip(range(start, end), ends, ends[1:])]
        flat, ends = lay(known.links, (np.cumsum(known.size) - known.size)[unit], known.size[unit], first)
        n_links = np.where(odd, 0, np.diff(ends))
        flat, owner = flat[np.repeat(~odd, np.diff(ends))], np.repeat(np.arange(n), n_links)
        order = np.lexsort((flat, owner))
        flat, owner = flat[order], owner[order]
        new = np.ones(len(flat), bool)
        new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(flat)))
        flat, owner = flat[at], owner[at]
        kinds = pa.StructArray.from_arrays([pa.array((flat >> np.uint64(32)).astype("i4")), pa.array((flat & np.uint64(0xFFFFFFFF)).astype("i4")), pa.array(times.astype("i4"))], ["a", "b", "n"])
        lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), kinds)
        return pa.RecordBatch.from_arrays([*(pa.array(counts[:, c]) for c in range(3)), pa.array(n_links), pa.array(told, pa.string()), lists], ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    @staticmethod
    def runs(groups: pa.Array, unit: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of texts whose groups take no more bytes than an Arrow array holds; of a single text they always do."""
        total = np.concatenate([[0], np.cumsum(pc.binary_length(groups).to_numpy(zero_copy_only=False).astype("i8")[unit])])[first]
        start, n = 0, len(first) - 1
        while start < n:
            end = max(start + 1, int(np.searchsorted(total, total[start] + (1 << 30), "right")) - 1)
            yield start, end
            start = end


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each worker and pair of files."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


LINKS = "array<struct<a: int, b: int, n: int>>"


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links (a, b, n: ids of A and B and how often they overlap).

    ``path_a``: a byte-level tokenizers file, ``path_b``: a sentencepiece model. Texts that are null or empty, and those that
    the tokens' bytes don't give back after a space, have no tokens: zeros, an empty text and no links. Rows
    that repeat are judged each by itself; an empty table gives an empty table; further columns are not carried.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = aligner(path_a, path_b)
        for b in batches:
            for start, end, texts in slices(b, size=2_000_000):
                out = e.documents(texts)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(start, end - start), *out.columns], ["doc_id", *out.schema.names])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links {LINKS}")


def link_counts(found: DataFrame) -> DataFrame:
    """a, b, count (how many links of all documents join them), best (no other a has more with this b)."""
    pairs = found.select(F.inline("links")).groupBy("a", "b").agg(F.sum("n").alias("count"))
    return pairs.join(pairs.groupBy("b").agg(F.max("count").alias("most")), "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align_tokens(docs: DataFrame, path_a: str, path_b: str, most: int = 1 << 22) -> DataFrame:
    """``aligned`` without its links, with n_best (links whose count is the highest of their b) and count_sum (sum of the counts of all links).

    Counts are broadcast if there are no more than ``most`` pairs of ids (17 bytes each); else the documents' links meet them in a join.
    """
    spark = docs.sparkSession
    at, counts_at = shared_dir(spark), shared_dir(spark)
    aligned(docs, path_a, path_b).write.option("compression", "zstd").parquet(at)
    found = spark.read.parquet(at)
    link_counts(found).write.parquet(counts_at)
    counts = spark.read.parquet(counts_at)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if counts.count() <= most:
        return summed(found, counts, names)
    own = found.withColumn("key", F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index")))
    each = own.select("key", F.inline("links"))
    one = each.groupBy("a", "b").agg(F.count(F.lit(1)).alias("rows")).join(counts, ["a", "b"])
    one = one.select(F.struct("a", "b").alias("pair"), F.col("rows").alias("n"), "count", "best")
    met = hot_join(each.select("key", F.struct("a", "b").alias("pair"), F.col("n").alias("times")), one, "pair")
    sums = met.groupBy("key").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    out = own.join(sums, "key", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_best", "count_sum")}).select(*names)


def summed(found: DataFrame, counts: DataFrame, names: list[str]) -> DataFrame:
    """n_best and count_sum by counts that every task holds."""
    t = counts.select("a", "b", "count", "best").toArrow()
    key = (t["a"].to_numpy().astype("u8") << np.uint64(32)) | t["b"].to_numpy().astype("u8")
    order = np.argsort(key)
    told = found.sparkSession.sparkContext.broadcast((key[order], t["count"].to_numpy()[order], t["best"].to_numpy()[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, many, best = told.value
        for b in batches:
            lists = b.column("links")
            a, c, n = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
            at = np.searchsorted(keys, (a.astype("u8") << np.uint64(32)) | c.astype("u8"))
            offsets = lists.offsets.to_numpy().astype("i8")
            offsets = offsets - offsets[0]
            ends = [np.concatenate([[0], np.cumsum(x)]) for x in (n.astype("i8") * best[at], n.astype("i8") * many[at])]
            held = {c: b.column(c) for c in names if c in b.schema.names}
            held |= {c: pa.array(x[offsets[1:]] - x[offsets[:-1]]) for c, x in zip(("n_best", "count_sum"), ends, strict=True)}
            yield pa.RecordBatch.from_arrays([held[c] for c in names], names)

    kinds = {"groups_sha256": "string"}
    return found.mapInArrow(run, ", ".join(f"{c} {kinds.get(c, 'long')}" for c in names))
