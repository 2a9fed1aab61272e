"""Helpers shared by the operators: the shared folder, table access and Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster names it in ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder takes its place, on one machine only (tests): on a cluster, executors could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    return f"{shared_base(spark)}/{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder, so that lost executors lose nothing.

    Spark deletes the files with the frame where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    shared_base(df.sparkSession)
    return df.checkpoint()


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def packed(df: DataFrame, *columns: str) -> DataFrame:
    """``row`` (all columns of ``df`` as one, so that no name of theirs clashes with another) beside some of them."""
    return df.select(F.struct("*").alias("row"), *columns)


def inside(df: DataFrame, name: str) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """Takes one column of ``df`` out of the ``row`` of a packed batch, so that it isn't sent twice; it is named ``text``."""
    at = df.columns.index(name)
    return lambda batch: pa.RecordBatch.from_arrays([batch.column("row").flatten()[at]], ["text"])


def map_packed(rows: DataFrame, run: Callable, kind: str) -> DataFrame:
    """Run ``run`` over Arrow batches of ``rows``; it yields batches of ``row`` and ``out`` (of type ``kind``)."""
    out = T.StructType([rows.schema["row"], T.StructField("out", T.StructType.fromDDL(f"out {kind}")[0].dataType)])
    return rows.mapInArrow(run, out)


def mark_of(df: DataFrame) -> Column:
    """64 bits that hang on all columns of a row; columns with maps, which have no hash, by what they look like as text and as JSON."""
    parts = []
    for f in df.schema.fields:
        c = F.col(quoted(f.name))
        held = "map<" in f.dataType.simpleString()
        parts += [c.cast("string"), F.to_json(F.struct(c), {"ignoreNullFields": "false"})] if held else [c]
    return F.xxhash64(*parts)


#: Rows that one row becomes in one task.
SPREAD_ROWS = 8192


def counted(df: DataFrame, n: str, name: str) -> DataFrame:
    """Each row ``n`` times (a column), numbered from 1 in ``name``; a row that is wanted more than SPREAD_ROWS times is dealt over the tasks."""
    few = df.where(F.col(n) <= SPREAD_ROWS).withColumn(name, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n).cast("long"))))
    start = fresh(df, "_start")
    many = df.where(F.col(n) > SPREAD_ROWS).withColumn(start, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1, F.lit(SPREAD_ROWS).cast("long"))))
    many = many.repartition(start).withColumn(name, F.explode(F.sequence(F.col(start) + 1, F.least(F.col(n).cast("long"), F.col(start) + SPREAD_ROWS)))).drop(start)
    return few.unionByName(many)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Keys with more than one row in ``HOT`` are joined apart: there are fewer of them than ``HOT``.
HOT = 256


def hot_join(many: DataFrame, one: DataFrame, key: str, total: int | None = None) -> DataFrame:
    """``many`` joined with ``one``, which has each key once, with ``n``, its rows in ``many`` (``total`` in all; None: their sum).

    Rows of ``one`` are of a bounded size. Those of the common keys, fewer than HOT, are broadcast, so that no key's rows meet in one task.
    """
    if total is None:
        total = one.agg(F.sum("n")).first()[0] or 0
    common = F.broadcast(one.where(F.col("n") * HOT > total))
    rest = many.join(common.select(key), key, "left_anti").join(one.where(F.col("n") * HOT <= total), key)
    return many.join(common, key).unionByName(rest)


def slices(batch: pa.RecordBatch, text: str = "text", size: int = 8_000_000) -> Iterator[tuple[int, int, pa.Array]]:
    """Runs of rows of a batch with about ``size`` bytes of text each: first row, end row, texts.

    Null texts come out empty. A text longer than ``size`` makes a run of its own.
    """
    column = batch.column(text)
    column = pc.fill_null(column.cast(pa.string()), "")
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype("i8")) if batch.num_rows else np.zeros(0, "i8")
    start, done = 0, 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
        yield start, end, column.slice(start, end - start)
        start, done = end, int(ends[end - 1])
    pa.default_memory_pool().release_unused()  # a worker that waits for its next task holds no more than it must


class Words:
    """The words of many texts, each distinct word once: texts are cut at every single space."""

    def __init__(self, texts: pa.Array) -> None:
        lists = pc.split_pattern(texts, " ")
        self.ends = lists.offsets.to_numpy().astype("i8") - lists.offsets[0].as_py()
        found = lists.flatten().dictionary_encode()
        self.at = found.indices.to_numpy()
        self.distinct: pa.Array = found.dictionary


def lay(flat: np.ndarray, start: np.ndarray, size: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of ``flat`` one after another; where the entries end that stand before each of ``ends`` (first 0)."""
    total = np.concatenate([[0], np.cumsum(size)])
    where = np.repeat(start - total[:-1], size)
    where += np.arange(total[-1])
    return flat[where], total[ends]


class Pool:
    """Entries of whole numbers, to be laid out word by word."""

    def __init__(self, entries: list[bytes], kind: str = "<u4") -> None:
        self.flat = np.frombuffer(b"".join(entries), kind)
        self.size = np.fromiter(map(len, entries), "i8", len(entries)) // self.flat.itemsize
        self.start = np.cumsum(self.size) - self.size

    def lay(self, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All entries in the order of ``at``; where each text's numbers end (first 0)."""
        return lay(self.flat, self.start[at], self.size[at], ends)


class Lexicon:
    """Words and the numbers that ``compute`` gives for them, kept in two flat arrays.

    Kept are at most ``most`` bytes, and no word of more than ``longest`` bytes: in scripts without spaces a word may be a whole
    text. ``compute`` takes an array of words and returns their numbers one after another, and how many each has.
    """

    def __init__(self, compute: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], most: int = 48 << 20, longest: int = 64) -> None:
        self.compute, self.most, self.longest = compute, most, longest
        self.forget()

    def forget(self) -> None:
        self.words, self.flat, self.size = pa.array([], pa.string()), np.zeros(0, "u4"), np.zeros(0, "i8")

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The numbers, and for each of ``words`` (all different) where its own start and how many they are."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype("i8")
        flat, size = self.flat, self.size
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            missing = words.take(pa.array(fresh))
            own, own_size = self.compute(missing)
            at[fresh] = len(size) + np.arange(len(fresh))
            flat, size = np.concatenate([flat, own]), np.concatenate([size, own_size])
            self.keep(missing, own, own_size)
        start = np.cumsum(size) - size
        return flat, start[at], size[at]

    def keep(self, words: pa.Array, flat: np.ndarray, size: np.ndarray) -> None:
        short = pc.less_equal(pc.binary_length(words), self.longest).to_numpy(zero_copy_only=False)
        words, flat, size = words.filter(pa.array(short)), flat[np.repeat(short, size)], size[short]
        if self.words.nbytes + words.nbytes + 4 * (len(self.flat) + len(flat)) > self.most:
            self.forget()
        if words.nbytes + flat.nbytes <= self.most:
            self.words = pa.concat_arrays([self.words, words])
            self.flat, self.size = np.concatenate([self.flat, flat]), np.concatenate([self.size, size])


class Memo:
    """A cache of two generations, each of at most ``most`` bytes: what is used stays, what is not goes.

    Keys of more than ``longest`` characters are held for the one call that asks for them.
    """

    def __init__(self, most: int = 16 << 20, longest: int = 64) -> None:
        self.most, self.longest, self.held, self.new, self.old, self.passing = most, longest, 0, {}, {}, []

    def missing(self, keys: set) -> list:
        """Keys that must be computed; the rest is made present in ``new``."""
        for k in self.passing:
            self.new.pop(k, None)
        self.passing = []
        if self.held > self.most:
            self.new, self.old, self.held = {}, self.new, 0
        out, found = [], {}
        for k in keys - self.new.keys():
            v = self.old.get(k)
            if v is None:
                out.append(k)
            else:
                found[k] = v
        self.add(found)
        return out

    def add(self, found: dict) -> None:
        self.new.update(found)
        self.passing += [k for k in found if len(k) > self.longest]
        self.held += sum(ENTRY_BYTES + len(k) + (len(v) if isinstance(v, bytes) else 0) for k, v in found.items())


#: What a dictionary entry takes besides its content, about.
ENTRY_BYTES = 150
