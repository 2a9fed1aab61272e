"""Token counts (operator 5) and the encoder that the shard writer uses.

The tokenizers library encodes. A tokenizer that drops white space never joins two sides of a
space, so an ordinary text is the sum of its words, and each worker asks the library for a word
only once while it stays in a store of bounded size.

Huge texts are encoded in overlapping chunks with offsets. A chunk may begin or end inside a
word, so its edges are wrong; two neighbours are spliced at a place in their overlap where both
start a token, white space stands before it, and both give the same tokens up to the next such
place. Where an overlap has no such place it is widened, if need be up to the whole left chunk.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import Lexicon, Words, lay, slices


#: Marks that may end a word; like letters they are a class of their own in the pattern below.
MARKS = '.,!?;:%$&*()"'
#: Letters whose small form is the same for a library that first composes (NFC) and then lowers, and a word of them.
SIMPLE = "^(?P<core>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<mark>[" + MARKS + "]*)$"


class Encoder:
    """Encodes whole texts by a tokenizers file, without added special tokens, cut or padding."""

    def __init__(self, path: str, chunk: int = 60_000, overlap: int = 300) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap = chunk, overlap
        self.words, self.parts = Lexicon(self.word_ids), Lexicon(self.library_ids)
        ids = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        if ids("ab\n cd ") != ids("ab") + ids("cd"):
            raise ValueError(f"{path}: white space makes tokens; texts can't be cut at it")
        rules = json.loads(self.tokenizer.to_str())
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]] for t in rules["added_tokens"]):
            raise ValueError(f"{path}: added tokens reach into white space; texts can't be cut at it")
        self.folds = folds(rules)
        self.mark = next(((c, ids(c)[0]) for c in "日人中大国" if len(ids(c)) == 1), None)

    def word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words of simple letters are asked for in small letters, apart from the marks that end them."""
        core, tail = words, pa.array([""] * len(words), pa.string())
        if self.folds:
            found = pc.extract_regex(words, SIMPLE)
            core = pc.if_else(pc.is_null(found), words, pc.utf8_lower(pc.struct_field(found, "core")))
            tail = pc.fill_null(pc.struct_field(found, "mark"), "")
        both = pa.concat_arrays([core, tail]).dictionary_encode()
        flat, start, size = self.parts.find(both.dictionary)
        at = both.indices.to_numpy().reshape(2, -1).T.ravel()
        out, ends = lay(flat, start[at], size[at], 2 * np.arange(len(words) + 1))
        return out, np.diff(ends)

    def library_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Many words in one call: a mark of one token stands after each, and tells where its tokens end."""
        held, flat, size = words.to_pylist(), [np.zeros(0, "u4")], [np.zeros(0, "i8")]
        for k in range(0, len(held), 1000):
            some, cut = held[k : k + 1000], np.zeros(0, "i8")
            if self.mark:
                sign, its_id = self.mark
                ids = np.array(self.tokenizer.encode_batch_fast([f" {sign} ".join([*some, ""])], add_special_tokens=False)[0].ids, "u4")
                cut = np.flatnonzero(ids == its_id)
            if len(cut) == len(some):
                flat.append(np.delete(ids, cut))
                size.append(np.diff(cut, prepend=-1) - 1)
            else:  # no mark, or a word that holds it
                each = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                flat += [np.array(i, "u4") for i in each]
                size.append(np.array(list(map(len, each)), "i8"))
        return np.concatenate(flat), np.concatenate(size)

    def tokens(self, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of one chunk and where in the text each token starts."""
        e = self.tokenizer.encode(text[start:end], add_special_tokens=False)
        at = np.fromiter((o[0] for o in e.offsets), "i8", len(e)) + start
        return np.array(e.ids, "<u4"), at

    def boundary(self, text: str, left: tuple, right: tuple, start: int, end: int) -> int | None:
        """A stable boundary of both chunks inside [start, end), or None."""
        (a, x), (b, y) = left, right
        both = np.intersect1d(x[x > start], y[y > start])
        both = [int(p) for p in both if p < end and text[p - 1].isspace()]
        for p, q in reversed(list(zip(both, both[1:], strict=False))):
            if np.array_equal(a[(x >= p) & (x < q)], b[(y >= p) & (y < q)]):
                return p
        return None

    def long(self, text: str) -> np.ndarray:
        """Ids of a huge text from overlapping chunks."""
        out, start, end, n = [], 0, min(self.chunk, len(text)), len(text)
        left = self.tokens(text, start, end)
        while end < n:
            overlap, cut = self.overlap, None
            while cut is None:
                begin = max(start, end - overlap)
                until = min(n, end + self.chunk)
                if begin == start:  # no stable place: the left chunk is encoded anew with what follows
                    left, end = self.tokens(text, start, until), until
                    break
                right = self.tokens(text, begin, until)
                cut = self.boundary(text, left, right, begin, end)
                overlap *= 2
            if cut is not None:
                out.append(left[0][left[1] < cut])
                keep = right[1] >= cut
                left, start, end = (right[0][keep], right[1][keep]), cut, until
        return np.concatenate([*out, left[0]])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids end (first 0)."""
        huge = np.flatnonzero(pc.greater(pc.utf8_length(texts), self.chunk).to_numpy(zero_copy_only=False))
        if len(huge):
            own = [self.long(texts[int(i)].as_py()) for i in huge]
            mask = np.zeros(len(texts), bool)
            mask[huge] = True
            texts = pc.if_else(pa.array(mask), "", texts)
        w = Words(pc.replace_substring(texts, "\n", " "))
        flat, start, size = self.words.find(w.distinct)
        flat, ends = lay(flat, start[w.at], size[w.at], w.ends)
        if not len(huge):
            return flat, ends
        size = np.diff(ends)
        size[huge] = list(map(len, own))
        parts = np.split(flat, ends[1:-1])
        for i, ids in zip(huge, own, strict=True):
            parts[i] = ids
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(size)])


def folds(rules: dict) -> bool:
    """Whether a tokenizers file lowers all letters and cuts between letters and other marks, read from its own rules."""
    kinds = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
    first = ((rules["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
    choices = first.get("pattern", {}).get("Regex", "").split("|") if first.get("type") == "Split" else []
    return "Lowercase" in kinds and set(kinds) <= {"NFC", "Replace", "Lowercase"} and {r"[\p{L}]+", r"[^\s\p{L}\p{N}]+"} <= set(choices)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, chunk: int = 60_000, overlap: int = 300) -> Encoder:
    """One encoder for each worker and file."""
    key = (path, chunk, overlap)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, chunk, overlap)
    return _ENCODERS[key]


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, chunk: int = 60_000, overlap: int = 300) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null texts count as empty: 0 bytes, 0 tokens. Texts of more than ``chunk`` characters go
    through overlapping chunks. Nothing is shuffled; an empty table gives an empty table; further
    columns are not carried.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, chunk, overlap)
        for b in batches:
            for start, end, texts in slices(b):
                _, ends = e.encode(texts)
                n = np.diff(ends)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(start, end - start), pc.binary_length(texts).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
