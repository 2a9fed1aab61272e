"""Numbers along an order of all rows, without one window over all rows.

Keys are whole numbers. Rows are summed within buckets of BUCKET keys, and one row for each bucket says what lies before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys in one bucket.
BUCKET = 65_536


def in_buckets(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("_bucket", F.floor(F.col(key) / BUCKET))


def sums_before(df: DataFrame, key: str, values: dict[str, Column], groups: tuple[str, ...] = ()) -> DataFrame:
    """Adds for each named value its sum over all rows before, in the order of ``groups`` and ``key``.

    ``groups`` and ``key`` together tell rows apart and aren't null.
    """
    by = [*groups, "_bucket"]
    b = in_buckets(df, key)
    sums = b.groupBy(*by).agg(*(F.sum(v).alias(f"_{n}") for n, v in values.items()))
    earlier = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)  # one row for each bucket
    before = sums.select(*by, *(F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in values))
    inside = Window.partitionBy(*by).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    d = b.join(before, by)
    d = d.select("*", *((F.col(f"_{n}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(n) for n, v in values.items()))
    return d.drop("_bucket", *(f"_{n}" for n in values))


def assign_rids(reads: DataFrame) -> DataFrame:
    """rid from 0 without holes and the bases before each read, in the order of files and of the reads in them.

    Columns: file, seq_id (number of the read in its file), rlen; others stay.
    """
    return sums_before(reads, "seq_id", {"rid": F.lit(1), "boff": F.col("rlen")}, ("file",))


def id_totals(reads: DataFrame) -> DataFrame:
    """One row: reads, bases, the longest read."""
    return reads.agg(F.count(F.lit(1)).alias("n_reads"), F.sum("rlen").alias("bases"), F.max("rlen").alias("longest"))


def runs_of(df: DataFrame, value: str, key: str, group: str) -> DataFrame:
    """Adds ``run``: the key of the first row of each run of consecutive rows of one value, by group. A null value is a run of its own."""
    b = in_buckets(df, key)
    ahead = Window.partitionBy(group).orderBy("_bucket")  # one row for each bucket
    own = Window.partitionBy(group, "_bucket").orderBy(key)
    last = b.groupBy(group, "_bucket").agg(F.max_by(F.struct(value), key).alias("_last"))
    last = last.select(group, "_bucket", F.lag("_last").over(ahead).alias("_last"))
    d = b.join(last, [group, "_bucket"]).withColumn("_prev", F.coalesce(F.lag(F.struct(value)).over(own), "_last"))
    start = F.when(F.coalesce(F.col("_prev")[value] != F.col(value), F.lit(True)), F.col(key))
    d = d.withColumn("_start", start)
    carried = d.groupBy(group, "_bucket").agg(F.max("_start").alias("_carried"))
    carried = carried.select(group, "_bucket", F.max("_carried").over(ahead.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    run = F.coalesce(F.max("_start").over(own.rowsBetween(Window.unboundedPreceding, 0)), "_carried")
    return d.join(carried, [group, "_bucket"]).withColumn("run", run).drop("_bucket", "_last", "_prev", "_start", "_carried")
