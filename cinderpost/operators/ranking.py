"""Exact row numbers without sorting a whole table or a whole group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinderpost.session import stage


def dense_index(df: DataFrame, key: str, out: str) -> DataFrame:
    """Number rows 0..n-1 in the order of ``key`` (unique, nulls first).

    Keys are range-partitioned once and written, each range is numbered by its own task, and
    the ranges before it are added as an offset. The offset table has one row per range.
    """
    ranges = stage(
        df.repartitionByRange(F.col(key).asc_nulls_first()).withColumn(
            "_range", F.spark_partition_id()
        ),
        "ranges",
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("_range")
        .agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_range").orderBy(F.col(key).asc_nulls_first())
    return (
        ranges.withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_range")
        .withColumn(out, F.col("_before") + F.col("_row") - 1)
        .drop("_range", "_row", "_before")
    )


def rank_within(
    df: DataFrame, group: str, bucket: str, order: list[str], out: str
) -> DataFrame:
    """1-based row number per ``group``, safe for a group that holds much of the table.

    ``bucket`` must never decrease along ``order``. Rows are numbered per (group, bucket), so
    a large group spreads over many tasks; the window over buckets only sees their counts. Rows
    without a group or bucket are a group or bucket of their own; null buckets come first.
    """
    before = (
        Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        df.groupBy(group, bucket)
        .agg(F.count("*").alias("_n"))
        .select(
            F.col(group).alias("_group"),
            F.col(bucket).alias("_bucket"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        )
    )
    inside = Window.partitionBy(group, bucket).orderBy(*order)
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(bucket).eqNullSafe(F.col("_bucket"))
    return (
        df.withColumn("_row", F.row_number().over(inside))
        .join(offsets, same)
        .withColumn(out, F.col("_before") + F.col("_row"))
        .drop("_row", "_before", "_group", "_bucket")
    )
