"""Token ids in sorted-string-table shards (operator 6).

Documents are dealt by ranges of their identifier and sorted; each task writes one shard. A shard
has blocks of prefix-compressed keys with the ids as values, a sparse index with the first key of
each block, a Bloom filter over all keys and a footer. A reader finds a document by the filter,
binary search in the index, and a scan of one block.

A shard is written under a name of its own and then renamed, so a task that runs again after a
lost executor puts the same shard in the same place.
"""

from __future__ import annotations

import bisect
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices
from .tokens import encoder

MAGIC = b"RWSST001"
FOOTER = struct.Struct("<QQQQQQB8s")
ENTRY = struct.Struct("<BBI")  # shared and own bytes of the key, bytes of the value
SPOT = struct.Struct("<BQI")  # bytes of the key, offset and bytes of the block
BLOCK = 1 << 16
BITS, PROBES = 10, 7


def key_of(doc_id: int | None) -> bytes:
    """Sorts as the identifier does; a null comes first."""
    return b"" if doc_id is None else struct.pack(">Q", doc_id + (1 << 63))


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key)[0] - (1 << 63) if key else None


def probes(key: bytes, bits: int) -> list[int]:
    a, b = zlib.crc32(key), zlib.crc32(key, 0x9E3779B9) | 1
    return [(a + i * b) % bits for i in range(PROBES)]


class Writer:
    """Appends documents in ascending order of their keys. ``width``: bytes of an id."""

    def __init__(self, out: BinaryIO, width: int) -> None:
        self.out, self.width, self.at, self.n_docs, self.n_ids = out, width, 0, 0, 0
        self.block, self.held, self.first, self.last = [], 0, b"", b""
        self.index: list[bytes] = []
        self.keys: list[bytes] = []
        self.press = zstandard.ZstdCompressor(level=1)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        key, value = key_of(doc_id), ids.astype(f"<u{self.width}").tobytes()
        if self.keys and key < self.keys[-1]:
            raise ValueError("keys must ascend")
        shared = 0
        if self.block:
            while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
                shared += 1
        else:
            self.first = key
        self.block += [ENTRY.pack(shared, len(key) - shared, len(value)), key[shared:], value]
        self.held += ENTRY.size + len(key) - shared + len(value)
        self.last = key
        self.keys.append(key)
        self.n_docs += 1
        self.n_ids += len(ids)
        if self.held >= BLOCK:
            self.flush()

    def put(self, raw: bytes) -> int:
        self.out.write(raw)
        self.at += len(raw)
        return len(raw)

    def flush(self) -> None:
        if self.block:
            at, size = self.at, self.put(self.press.compress(b"".join(self.block)))
            self.index.append(SPOT.pack(len(self.first), at, size) + self.first)
            self.block, self.held = [], 0

    def close(self) -> None:
        self.flush()
        index_at, index_size = self.at, self.put(b"".join(self.index))
        bits = max(64, BITS * self.n_docs)
        filled = np.zeros(bits, bool)
        for key in self.keys:
            filled[probes(key, bits)] = True
        filter_at, _ = self.at, self.put(np.packbits(filled).tobytes())
        self.put(FOOTER.pack(index_at, index_size, filter_at, bits, self.n_docs, self.n_ids, self.width, MAGIC))


class Reader:
    """Reads one shard; ``get`` touches one block at most."""

    def __init__(self, path: str) -> None:
        where, name = fs.FileSystem.from_uri(path)
        self.file = where.open_input_file(name)
        size = self.file.size()
        index_at, index_size, filter_at, self.bits, self.n_docs, self.n_ids, self.width, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a shard")
        self.filter = np.unpackbits(np.frombuffer(self.file.read_at(size - FOOTER.size - filter_at, filter_at), "u1"), count=self.bits)
        raw, p = self.file.read_at(index_size, index_at), 0
        self.firsts: list[bytes] = []
        self.blocks: list[tuple[int, int]] = []
        while p < index_size:
            n, at, length = SPOT.unpack_from(raw, p)
            p += SPOT.size
            self.firsts.append(raw[p : p + n])
            self.blocks.append((at, length))
            p += n

    def block(self, k: int) -> Iterator[tuple[bytes, np.ndarray]]:
        at, size = self.blocks[k]
        raw, p, key = zstandard.ZstdDecompressor().decompress(self.file.read_at(size, at)), 0, b""
        while p < len(raw):
            shared, own, length = ENTRY.unpack_from(raw, p)
            p += ENTRY.size
            key = key[:shared] + raw[p : p + own]
            p += own
            yield key, np.frombuffer(raw, f"<u{self.width}", length // self.width, p)
            p += length

    def scan(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for k in range(len(self.blocks)):
            for key, ids in self.block(k):
                yield id_of(key), ids

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every document of that identifier, most often one or none."""
        key, out = key_of(doc_id), []
        if not self.filter[probes(key, self.bits)].all():
            return out
        for k in range(max(0, bisect.bisect_left(self.firsts, key) - 1), bisect.bisect_right(self.firsts, key)):
            out += [ids for found, ids in self.block(k) if found == key]
        return out


def write_token_shards(docs: DataFrame, path: str, end_id: int, out: str, shards: int | None = None) -> DataFrame:
    """Encode whole texts, end each with ``end_id`` and write shards below ``out``.

    ``shards``: how many ranges to deal into; None leaves it to Spark, which follows the size.
    Returns the list of shards in ascending order of identifiers: shard, path, n_docs, n_ids, and
    start (ids in all shards before). It is written to ``out``/shards and read back from there. Null texts count as
    empty and have only the end id; rows with a null identifier come first; rows with the same one are
    all kept, ordered by text. An empty table gives no shards. Further columns are not carried.
    """
    spark, width = docs.sparkSession, 2 if max(end_id, encoder(path).tokenizer.get_vocab_size()) < 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, w, where = encoder(path), None, None
        shard = TaskContext.get().partitionId()
        for b in batches:
            for start, end, texts in slices(b):
                if w is None:
                    where, folder = fs.FileSystem.from_uri(out)
                    where.create_dir(folder, recursive=True)
                    own = posixpath.join(folder, f".{uuid.uuid4().hex}.part")
                    w = Writer(where.open_output_stream(own), width)
                flat, ends = e.encode(texts)
                for i, ids in zip(b.column("doc_id").slice(start, end - start).to_pylist(), np.split(flat, ends[1:-1]), strict=True):
                    w.add(i, np.append(ids, np.uint32(end_id)))
        if w is not None:
            w.close()
            w.out.close()
            name = f"shard-{shard:06d}.sst"
            where.move(own, posixpath.join(folder, name))
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "path": [f"{out}/{name}"], "n_docs": pa.array([w.n_docs], pa.int64()), "n_ids": pa.array([w.n_ids], pa.int64())})

    sorted_docs = docs.select("doc_id", "text").repartitionByRange(*([shards] if shards else []), "doc_id").sortWithinPartitions("doc_id", "text")
    sorted_docs.mapInArrow(run, "shard long, path string, n_docs long, n_ids long").write.parquet(f"{out}/shards")
    done = spark.read.parquet(f"{out}/shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shard
    return done.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_shards(spark: SparkSession, shards: DataFrame) -> DataFrame:
    """Read shards back: doc_id, start (ids of all documents before), ids (little-endian unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist(), strict=True):
                held: list[tuple] = []
                for doc_id, ids in Reader(path).scan():
                    held.append((doc_id, start, ids))
                    start += len(ids)
                    if len(held) == 1000:
                        yield batch_of(held)
                        held = []
                if held:
                    yield batch_of(held)

    def batch_of(held: list[tuple]) -> pa.RecordBatch:
        a, b, c = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([x.astype("<u4").tobytes() for x in c], pa.binary())], ["doc_id", "start", "ids"])

    return dealt(shards).mapInArrow(run, "doc_id long, start long, ids binary")


def shard_digests(shards: DataFrame) -> DataFrame:
    """Read shards back: doc_id, start, n_tokens, ids_crc32, the ids themselves left in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist(), strict=True):
                rows = []
                for doc_id, ids in Reader(path).scan():
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return dealt(shards).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def dealt(shards: DataFrame) -> DataFrame:
    """A task for each shard, as far as round robin goes."""
    return shards.select("path", "start").repartition(max(1, shards.count()))
