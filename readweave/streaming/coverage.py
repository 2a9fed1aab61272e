"""A coverage count that grows with every batch of alignments, and the repeat mask that follows from it.

Additions commute, so what is kept is a log of (rid, pos, delta) rows, one folder for each micro-batch. Spark's stateful
``dropDuplicates`` keeps an alignment that is sent twice from being counted twice; a batch that is run again after a failure
overwrites its own folder. Coverage is the running sum over the log, saturated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from readweave.operators.intervals import merge_intervals

#: Fixed value: counts saturate here.
FULL = 255

DELTAS = "rid long, pos long, delta long"


def coverage_deltas(o: DataFrame, keep_ends: int = 0, mask_contained: bool = False) -> DataFrame:
    """+1 and -1 rows of overlaps; those of one batch and pair that touch count once. ``keep_ends`` bases at both read ends stay bare.

    With ``mask_contained`` a read that one alignment covers fully is saturated from end to end. Rows without a batch are one batch.
    """
    batch = F.col("batch_id") if "batch_id" in o.columns else F.lit(0)
    spans = o.select(batch.alias("batch_id"), "aread", "bread", F.greatest("abpos", F.lit(keep_ends)).alias("beg"), F.least("aepos", F.col("alen") - keep_ends).alias("end_")).where("beg < end_")
    one = merge_intervals(spans, by=("batch_id", "aread", "bread")).select(F.col("aread").alias("rid"), "beg", "end_", F.lit(1).alias("w"))
    if mask_contained:
        whole = o.where("abpos = 0 and aepos = alen").select(F.col("aread").alias("rid"), F.lit(0).alias("beg"), F.col("alen").alias("end_"), F.lit(FULL).alias("w"))
        one = one.unionByName(whole)
    rows = one.select("rid", F.inline(F.array(F.struct(F.col("beg").cast("long").alias("pos"), F.col("w").cast("long").alias("delta")), F.struct(F.col("end_").cast("long").alias("pos"), (-F.col("w")).cast("long").alias("delta")))))
    return rows.groupBy(F.col("rid").cast("long").alias("rid"), "pos").agg(F.sum("delta").alias("delta"))


def coverage_runs(deltas: DataFrame) -> DataFrame:
    """rid, beg, end_, cov: stretches of equal coverage, saturated at FULL."""
    w = Window.partitionBy("rid").orderBy("pos")
    at = deltas.groupBy("rid", "pos").agg(F.sum("delta").alias("delta"))
    runs = at.select("rid", F.col("pos").alias("beg"), F.lead("pos").over(w).alias("end_"), F.least(F.sum("delta").over(w), F.lit(FULL)).alias("cov"))
    return runs.where("end_ is not null and cov > 0")


def mask_from_coverage(runs: DataFrame, expected: int, initial: DataFrame | None = None) -> DataFrame:
    """Union of the stretches above twice the expected coverage and, if given, of an initial mask (rid, beg, end_)."""
    high = runs.where(F.col("cov") > 2 * expected).select("rid", "beg", "end_")
    return merge_intervals(high if initial is None else high.unionByName(initial.select("rid", "beg", "end_")), by=("rid",))


def coverage_stream(
    stream: DataFrame,
    log: str,
    checkpoint: str,
    keep_ends: int = 0,
    mask_contained: bool = False,
    frozen: bool = False,
    expected: int | None = None,
    initial: DataFrame | None = None,
    snapshots: str | None = None,
    every: str | None = None,
    watermark: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Add the stream's alignments (batch_id, ovl_id, ...) to the log; with ``snapshots``, also write the mask after each trigger.

    ``frozen``: batches are read but change nothing. ``every``: time between triggers; without it, all that is there is read and the
    query ends. A batch that brings nothing new writes no snapshot. ``watermark`` (column, delay) lets the state of
    ``dropDuplicates`` expire, which the original has not.
    """
    if watermark:
        once = stream.withWatermark(*watermark).dropDuplicatesWithinWatermark(["batch_id", "ovl_id"])
    else:
        once = stream.dropDuplicates(["batch_id", "ovl_id"])

    def add(rows: DataFrame, epoch: int) -> None:
        rows.persist()
        try:
            # Every partition has to be read, so that the state of dropDuplicates is written whatever follows.
            if rows.count() == 0 or frozen:
                return
            coverage_deltas(rows, keep_ends, mask_contained).write.mode("overwrite").parquet(f"{log}/epoch={epoch}")
            if snapshots and expected is not None:
                mask_from_coverage(coverage_runs(read_log(rows.sparkSession, log)), expected, initial).write.mode("overwrite").parquet(f"{snapshots}/epoch={epoch}")
        finally:
            rows.unpersist()

    writer = once.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """All delta rows written so far."""
    return spark.read.schema(f"{DELTAS}, epoch int").parquet(log).drop("epoch")
