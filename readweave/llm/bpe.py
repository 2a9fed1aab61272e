"""Byte-level BPE encoding and decoding (operator 1).

Merges run on a segment tree over byte positions. Leaf i holds the rank of the pair that starts
at byte i (and i itself, so that equal ranks are taken leftmost first); the root is the next
merge. A merge changes the leaves of the merged token, of its live left neighbour and of the
token that vanished, and each of them is carried to the root in log(size) steps. Many short
pieces are merged side by side, one numpy row each; long ones one at a time.

Spark partitions the documents; nothing is shuffled. Each Python worker keeps a bounded cache of
the pieces that it has merged.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, Pool, Words, inside, map_packed, packed, slices

#: A single space between two characters that are not white space always starts a new piece.
CLEAN_SPACE = re.compile(r"(?<=\S) (?=\S)")
NONE = np.int64(1) << np.int64(60)
LONGEST_ROW = 64
#: Bytes of text that are encoded at a time beside whole rows.
SLICE = 4_000_000


class Codec:
    """Encodes and decodes with the ranks of a tiktoken file and a pattern that splits text."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.size = max(self.ranks.values()) + 1
        self.tokens = [b""] * self.size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], "i8")
        keys, values = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.size + b)
                    values.append(rank)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = np.array(keys, "i8")[order], np.array(values, "i8")[order]
        self.parts, self.pieces = Memo(), Memo()

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def merge_rows(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Pieces of 2 to ``size`` bytes (a power of two), all at once."""
        n = len(pieces)
        length = np.fromiter(map(len, pieces), "i8", n)
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), "u1").reshape(n, size)
        at = np.arange(size)
        ids = np.where(at < length[:, None], self.bytes[raw], -1)
        ids = np.concatenate([ids, np.full((n, 1), -1)], 1)
        after = np.where(at + 1 < length[:, None], at + 1, size)
        before = np.broadcast_to(at - 1, (n, size)).copy()
        bits = size.bit_length() - 1
        tree = np.full((n, 2 * size), NONE)
        first = self.pair_rank(ids[:, : size - 1], ids[:, 1:size])
        first[ids[:, 1:size] < 0] = NONE
        tree[:, size : 2 * size - 1] = np.where(first < NONE, first << bits | at[:-1], NONE)
        for level in range(bits - 1, -1, -1):
            lo, hi = 1 << level, 2 << level
            tree[:, lo:hi] = np.minimum(tree[:, 2 * lo : 2 * hi : 2], tree[:, 2 * lo + 1 : 2 * hi : 2])
        ids, after, before, tree = ids.ravel(), after.ravel(), before.ravel(), tree.ravel()
        rows = np.flatnonzero(tree[1 :: 2 * size] < NONE)
        while len(rows):
            base, cell, wide = rows * size, rows * (size + 1), rows * (2 * size)
            top = tree[wide + 1]
            rank, i = top >> bits, top & (size - 1)
            j = after[base + i]
            k, h = after[base + j], before[base + i]
            ids[cell + i], ids[cell + j] = rank, -1
            after[base + i] = k
            inner, has = k < size, h >= 0
            before[(base + k)[inner]] = i[inner]
            right = self.pair_rank(rank, ids[cell + k])
            left = self.pair_rank(ids[cell + h], rank)
            tree[wide + size + j] = NONE
            tree[wide + size + i] = np.where(inner & (right < NONE), right << bits | i, NONE)
            spot, left, h = (wide + size + h)[has], left[has], h[has]
            tree[spot] = np.where(left < NONE, left << bits | h, NONE)
            start = np.concatenate([wide, wide, wide[has]])
            node = (np.concatenate([i, j, h]) + size) >> 1
            for _ in range(bits):
                child = start + 2 * node
                tree[start + node] = np.minimum(tree[child], tree[child + 1])
                node >>= 1
            rows = rows[tree[wide + 1] < NONE]
        kept = ids.reshape(n, size + 1)
        live = kept >= 0
        raw, ends = kept[live].astype("<u4").tobytes(), 4 * np.cumsum(live.sum(1))
        return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def merge_one(self, piece: bytes) -> np.ndarray:
        """One piece of any length on plain lists."""
        n, none = len(piece), (1 << 60)
        size = 1 << (n - 1).bit_length()
        part: list = [piece[i : i + 1] for i in range(n)]
        after, before, rank_of = list(range(1, n + 1)), list(range(-1, n - 1)), self.ranks.get
        tree = [none] * (2 * size)
        for i in range(n - 1):
            r = rank_of(piece[i : i + 2])
            if r is not None:
                tree[size + i] = r * size + i
        for v in range(size - 1, 0, -1):
            tree[v] = min(tree[2 * v], tree[2 * v + 1])

        def put(leaf: int, r: int | None) -> None:
            v = leaf + size
            tree[v] = none if r is None else r * size + leaf
            v >>= 1
            while v:
                a, b = tree[2 * v], tree[2 * v + 1]
                tree[v] = a if a < b else b
                v >>= 1

        while tree[1] < none:
            i = tree[1] % size
            j = after[i]
            part[i] += part[j]
            part[j] = None
            k = after[i] = after[j]
            put(j, None)
            if k < n:
                before[k] = i
            put(i, rank_of(part[i] + part[k]) if k < n else None)
            h = before[i]
            if h >= 0:
                put(h, rank_of(part[h] + part[i]))
        return np.array([self.ranks[p] for p in part if p is not None], "<u4")

    def encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        out, rows = {}, {}
        for p in pieces:
            raw = p.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                out[p] = whole.to_bytes(4, "little")
            elif len(raw) <= LONGEST_ROW:
                rows.setdefault(1 << (len(raw) - 1).bit_length(), []).append((p, raw))
            else:
                out[p] = self.merge_one(raw).tobytes()
        for size, held in rows.items():
            for k in range(0, len(held), 4096):
                some = held[k : k + 4096]
                out.update(zip((p for p, _ in some), self.merge_rows([r for _, r in some], size), strict=True))
        return out

    def split(self, part: str) -> list[str]:
        """What the pattern gives for a part; for letters, with or without one mark behind, it is plain."""
        own = part[1:] if part[0] == " " else part
        if own.isalpha():
            return [part]
        if own[:-1].isalpha() and own[-1] in ".,":
            return [part[:-1], own[-1]]
        return self.pattern.findall(part)

    def merged(self, pieces: set[str]) -> dict[str, bytes]:
        """The cache, with all these pieces in it."""
        missing = self.pieces.missing(pieces)
        self.pieces.add(self.encode_pieces(missing))
        return self.pieces.new

    def entries(self, parts: list[str]) -> list[bytes | int]:
        """The ids of parts, which may begin with one space; 0 for a part that else begins or ends in white space, or is empty."""
        split, missing = {}, self.parts.missing(set(parts))
        made = {}
        for c in missing:
            if c[-1:].isspace() or c[c[:1] == " " :][:1].isspace() or not c:
                made[c] = 0
            else:
                split[c] = self.split(c)
        piece = self.merged({p for v in split.values() for p in v})
        for c, v in split.items():
            made[c] = piece[v[0]] if len(v) == 1 else b"".join([piece[p] for p in v])
        self.parts.add(made)
        return list(map(self.parts.new.__getitem__, parts))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, as encode_ordinary of the tiktoken library gives them, and where each text's ids end (first 0).

        Words are cut at single spaces. Where such a cut has other white space beside it, the text
        is cut anew at its clean spaces alone.
        """
        w = Words(texts)
        first, distinct = w.ends[:-1], w.distinct.to_pylist()
        heads = [distinct[i] for i in w.at[first]]
        at = w.at.copy()
        at[first] = len(distinct) + np.arange(len(heads))
        entries = self.entries([" " + c for c in distinct]) + self.entries(heads)
        unclean = np.array([e == 0 for e in entries])
        flat, ends = Pool([e or b"" for e in entries]).lay(at, w.ends)
        if not unclean.any() or not len(at):
            return flat, ends
        again = np.flatnonzero(np.add.reduceat(unclean[at], first) > 0)
        out = np.split(flat, ends[1:-1])
        for i in again:
            out[i] = self.encode_unclean(texts[int(i)].as_py())
        return np.concatenate(out), np.concatenate([[0], np.cumsum([len(x) for x in out])])

    def encode_unclean(self, text: str) -> np.ndarray:
        """A text with spaces beside other white space."""
        first, *rest = CLEAN_SPACE.split(text)
        pieces = [p for part in (first, *(" " + r for r in rest)) for p in self.pattern.findall(part)]
        known = self.merged(set(pieces))
        return np.frombuffer(b"".join([known[p] for p in pieces]), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker and vocabulary."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def bpe_encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids`` (array of int), the token ids of each whole text.

    Null texts count as empty and give an empty array. A column that is already named ``ids`` is
    replaced; all others, rows that repeat included, come through as they are. An empty table
    gives an empty table.
    """
    rows, own = packed(docs.drop(ids)), inside(docs.drop(ids), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            for start, end, texts in slices(own(b), size=SLICE):
                found, ends = c.encode(texts)
                column = pa.ListArray.from_arrays(pa.array(ends.astype("i4")), pa.array(found.astype("i4")))
                yield pa.RecordBatch.from_arrays([b.column("row").slice(start, end - start), column], ["row", "out"])

    return map_packed(rows, run, "array<int>").select("row.*", F.col("out").alias(ids))


def bpe_decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out`` (binary), the bytes that ``ids`` stand for; null ids give null, no ids no bytes.

    A column that is already named ``out`` is replaced; all others, rows that repeat included, come through; an empty table gives an empty table.
    """
    rows = packed(df.drop(out), ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            column = [None if v is None else c.decode(np.array(v, "u4")) for v in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(column, pa.binary())], ["row", "out"])

    return map_packed(rows, run, "binary").select("row.*", F.col("out").alias(out))


def bpe_round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode each whole text and decode the ids again; digests of both.

    One row per row of ``docs``: doc_id, n_tokens, ids_sha256 (decimal ids, one space between),
    decoded_sha256. Null and empty texts have no tokens and the digest of no bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        digits = [b"%d" % i for i in range(c.size)].__getitem__
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for _, _, texts in slices(b):
                ids, ends = c.encode(texts)
                for own in np.split(ids, ends[1:-1]):
                    n.append(len(own))
                    ids_sha.append(hashlib.sha256(b" ".join(map(digits, own.tolist()))).hexdigest())
                    text_sha.append(hashlib.sha256(c.decode(own)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
