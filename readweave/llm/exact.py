"""Exact dedup as a stream with keyed state (operator 3).

Each micro-batch adds its texts to keyed state on disk (RocksDB): digest -> the identifier that stays, the locator of its content
(file and row) and how many rows have come. The state has no expiry. Rows with the same digest are combined before the
shuffle, so a text that a third of all rows share costs one state row for each task. A hit is never taken on the digest's
word: the full bytes of all rows with a digest that has come twice are compared with those at the locator. They are combined by
digest and whole text before that shuffle, so a common text travels once for each task. Rows that differ (a collision
of digests) are grouped by the text itself and told apart by their own locators.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, hot_join, shared_dir

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def locator() -> list[Column]:
    """File and row of each row of a Parquet table."""
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def digest_state(spark: SparkSession, path: str, schema: T.StructType, at: str, digest=sha256, files_per_batch: int = 4096, partitions: int | None = None) -> DataFrame:
    """Run the stream over the table at ``path`` until all its rows are in; returns the final state.

    ``at``: the stream's own folder (offsets, commits, state) in the shared folder. Started again with the
    same folder it goes on where it stopped, with rows that have come since, however old their files are. ``partitions`` of the state
    are fixed at its first start, to twice the cores unless given: each keeps a store of its own with some 4 MB of files
    however little it holds. Rows: digest, keep_id (largest doc_id), file and row (where its content stands), n (rows).
    """
    partitions = partitions or max(8, 2 * spark.sparkContext.defaultParallelism)
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.streaming.internal.stateStore.partitions": str(partitions)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        # As a pattern, a table of one file is as good as a folder.
        path = path.rstrip("/")
        pattern = path if re.search(r"[\[\]{}*?]", path) else f"{path[:-1]}[{path[-1]}]"
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", "36500d").parquet(pattern)
        holder = F.max(F.struct("doc_id", *locator())).alias("holder")
        state = rows.groupBy(digest(F.coalesce("text", F.lit(""))).alias("digest")).agg(holder, F.count(F.lit(1)).alias("n"))
        query = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", at).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    found = spark.read.format("statestore").load(at)
    (key,), value = found.schema["key"].dataType.fieldNames(), found.schema["value"].dataType.fieldNames()
    found = found.select(F.col(f"key.`{key}`").alias("digest"), F.col(f"value.`{value[0]}`").alias("holder"), F.col(f"value.`{value[1]}`").alias("n"))
    return found.select("digest", F.col("holder.doc_id").alias("keep_id"), "holder.file", "holder.row", "n")


#: Bits of a filter that spares rows a shuffle: 2048 rows of 4 KB at most, 8 MB.
FILTER_BITS = 1 << 26


def only_present(rows: DataFrame, wanted: DataFrame, *key: str) -> DataFrame:
    """Rows whose ``key`` may be among those of ``wanted``: a bitmap of hashed keys, of bounded size, is broadcast.

    It lets some others through, which the join that follows drops, and none of ``wanted`` out. The more bits are set, the more it lets through.
    """
    at = F.pmod(F.xxhash64(*key), F.lit(FILTER_BITS)) + 1
    bucket, bit = F.bitmap_bucket_number(at), F.bitmap_bit_position(at)
    bits = wanted.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    byte = F.conv(F.hex(F.substr("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    found = rows.withColumn("_bucket", bucket).join(F.broadcast(bits), "_bucket")
    return found.where(F.floor(byte / F.pow(F.lit(2), bit % 8)).cast("long") % 2 == 1).drop("_bucket", "_bits")


def exact_dedup(spark: SparkSession, path: str, digest=sha256, partitions: int | None = None) -> DataFrame:
    """One row per row of the table at ``path`` (Parquet; doc_id long, text string).

    doc_id, keep_id (largest doc_id of the equal texts), group_size (rows with that text), kept
    (doc_id is keep_id), text_sha256. Null texts are equal to empty ones. Rows that repeat both
    identifier and text are one document and all say the same; null identifiers never win
    over others. An empty table gives an empty table; further columns are not carried.
    """
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    state = digest_state(spark, path, schema, shared_dir(spark), digest, partitions=partitions)
    text = F.coalesce("text", F.lit(""))
    rows = spark.read.schema(schema).parquet(path).select("doc_id", text.alias("text"), digest(text).alias("digest"), *locator())
    place = state.select("digest", "keep_id", "n")
    marked = hot_join(rows.select("doc_id", "digest", F.sha2("text", 256).alias("text_sha256"), "file", "row"), place, "digest")
    # Hits: whole texts of digests that came twice or more; single texts need no look at their bytes.
    several = state.where("n > 1").select("digest", "file", "row")
    hits = only_present(rows, several, "digest").groupBy("digest", "text").agg(F.max("doc_id").alias("own_id"), F.count(F.lit(1)).alias("own_n"))
    held = only_present(rows.select("text", "file", "row"), several, "file", "row").join(several, ["file", "row"]).select("digest", F.col("text").alias("held"))
    # A text that is not the one at the locator is a collision.
    other = checkpointed(hits.join(held, "digest").where(F.col("text") != F.col("held")).drop("held"))
    if other.isEmpty():
        return marked.select("doc_id", "keep_id", F.col("n").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    # The rows of those texts leave the digest's group; byte equality alone says which they are.
    gone = other.groupBy("digest").agg(F.sum("own_n").alias("gone"))
    apart = only_present(rows.select("file", "row", "digest", "text"), other, "digest").join(other, ["digest", "text"]).select("file", "row", "own_id", "own_n")
    out = marked.join(gone, "digest", "left").join(apart, ["file", "row"], "left")
    keep = F.when(F.col("own_n").isNull(), F.col("keep_id")).otherwise(F.col("own_id"))
    n = F.coalesce("own_n", F.col("n") - F.coalesce("gone", F.lit(0)))
    return out.select("doc_id", keep.alias("keep_id"), n.alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT d.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, d.doc_id = g.keep_id AS kept, sha256(d.text) AS text_sha256
FROM d JOIN g ON d.text = g.text
"""
