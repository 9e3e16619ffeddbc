"""Helpers shared by the operators: tables, row keys, joins to measured tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderpost.operators.lookup import BROADCAST_BYTES, measured_bytes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """96 bits, never null, that stand for a document's id and whole text.

    Rows that agree in both are the same document to every operator, so they may share a key.
    """
    return F.struct(
        F.xxhash64(doc_id, text).alias("a"),
        F.hash(text, doc_id, F.length(text)).alias("b"),
    )


def joined(
    rows: DataFrame, small: DataFrame, key: str | list[str], how: str = "left", limit: int | None = None
) -> DataFrame:
    """Join ``rows`` to a written table, broadcast only when its counted bytes allow it.

    Beyond the limit (BROADCAST_BYTES) it is a shuffle join, in which AQE splits the partitions of
    hot keys. Rows without a key, which no entry matches, are spread over all of them; a list of
    keys is taken to have no null ones.
    """
    if measured_bytes(small) <= (BROADCAST_BYTES if limit is None else limit):
        return rows.join(F.broadcast(small), key, how)
    if how not in ("left", "left_anti") or not isinstance(key, str):
        return rows.join(small, key, how)
    others = [c for c in rows.columns if c != key]
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*others), F.lit(4096))).otherwise(F.lit(0).cast("long"))
    return (
        rows.withColumn("__spread", spread)
        .join(small.withColumn("__spread", F.lit(0).cast("long")), [key, "__spread"], how)
        .drop("__spread")
    )

