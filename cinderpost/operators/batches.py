"""Repeatable shuffling, mini-batches, and descent batch by batch."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderpost.functions import scoring as S
from cinderpost.operators.features import BIAS
from cinderpost.operators.lookup import BROADCAST_BYTES, PlacedRows, measured_bytes, well_supported
from cinderpost.operators.network import gradient_step
from cinderpost.operators.ranking import dense_index
from cinderpost.session import discard, stage

BATCH = 256
# Batches whose rows lie in one folder; inside it they are found by the files' own statistics.
SHELF = 64


def _order(seed: int, key: str) -> Column:
    """Random but repeatable: a digest of seed and key, then the key itself."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return F.struct(digest.alias("digest"), F.col(key).alias("key"))


def shuffled(df: DataFrame, seed: int, key: str = "id") -> DataFrame:
    """All rows in a random but repeatable order of ``key``."""
    return df.orderBy(_order(seed, key))


def permutation(df: DataFrame, seed: int, key: str = "id", out: str = "place") -> DataFrame:
    """Add each row's place, 0..n-1, in the order of ``shuffled``.

    Ranges of the order are numbered apart and shifted by the rows before them, so no task sorts
    all rows. Keys that are equal get places beside each other; a null key is a key like others.
    """
    return dense_index(df.withColumn("_order", _order(seed, key)), "_order", out).drop("_order")


def minibatches(df: DataFrame, size: int = BATCH, key: str = "id") -> DataFrame:
    """Add ``batch``: consecutive runs of exactly ``size`` rows by ``key``, the last one short."""
    numbered = dense_index(df, key, "_rank")
    return numbered.withColumn("batch", F.floor(F.col("_rank") / size)).drop("_rank")


def shuffled_minibatches(df: DataFrame, seed: int, size: int = BATCH, key: str = "id") -> DataFrame:
    """Exact-size batches over the places of ``permutation``."""
    placed = permutation(df, seed, key, "_place")
    return placed.withColumn("batch", F.floor(F.col("_place") / size)).drop("_place")


@dataclass
class BatchedRows:
    """Rows ``id, target, feature, value`` laid out by batch; a batch is read without the others."""

    rows: DataFrame
    batches: int
    hot: DataFrame | None = None

    def read(self, batch: int) -> PlacedRows:
        own = self.rows.filter((F.col("shelf") == batch // SHELF) & (F.col("batch") == batch)).drop("shelf", "batch")
        rare = None if self.hot is None else own.join(F.broadcast(self.hot), "feature", "left_anti")
        return PlacedRows(own, own.filter(F.col("feature") == BIAS).select("id", "target"), "id", self.hot, rare)


@contextmanager
def batched_rows(
    rows: DataFrame, batches: DataFrame, weights: DataFrame | None = None, broadcast_bytes: int | None = None
) -> Iterator[BatchedRows]:
    """Lay out rows once by the ``batch`` (from 0) that ``id, batch`` gives their post.

    Batches are dealt into folders of SHELF batches, and sorted inside their files: a step opens
    one folder, of which the files' statistics leave the batch. Labels outside 0/1 are an error.
    If ``weights``, whose size never changes, are too many to broadcast, the features are counted
    once, and only the frequent ones meet their rows where these lie.
    """
    spread = rows.withColumn("target", S.checked_label("target")).join(batches.select("id", "batch"), "id")
    last = batches.agg(F.max("batch")).first()[0]
    shelved = (
        spread.withColumn("shelf", F.floor(F.col("batch") / SHELF).cast("int"))
        .repartitionByRange("batch", "id")  # a large batch is read by many tasks
        .sortWithinPartitions("batch", "id")
    )
    written = stage(shelved, "batches", partition_by=("shelf",))
    hot, limit = None, BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    if weights is not None and (size := measured_bytes(weights)) > limit:
        counts = stage(written.groupBy("feature").agg(F.count("*").alias("n")), "feature-counts")
        each = F.lit(-(-size // max(1, weights.count())))
        hot = stage(well_supported(counts, "feature", "n", each, limit // 2), "hot-keys")
        discard(counts)
    try:
        yield BatchedRows(written, 0 if last is None else int(last) + 1, hot)
    finally:
        discard(written, *([] if hot is None else [hot]))


def batch_descent(
    rows: DataFrame,
    batches: DataFrame,
    weights: DataFrame,
    hidden: int,
    rate: float,
    epochs: int,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """``feature, w`` after ``epochs`` passes over the batches in their order, one step for each.

    ``weights`` is a written table with arrays ``w``, the output layer included if there is a
    hidden one. A step reads its batch and the weights, and writes the weights.
    """
    given = weights
    with batched_rows(rows, batches, weights, broadcast_bytes) as laid:
        for _ in range(epochs):
            for batch in range(laid.batches):
                after, _ = gradient_step(laid.read(batch), weights, hidden, rate)
                if weights is not given:
                    discard(weights)
                weights = after
    return weights
