"""Confusion counts, accuracy and the report table; one aggregation each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderpost.functions.scoring import checked_label


def _cells() -> list[Column]:
    pred, target = F.col("_pred"), F.col("_target")
    return [
        F.count_if((pred == p) & (target == t)).alias(name)
        for name, p, t in (("tn", 0, 0), ("fn", 0, 1), ("fp", 1, 0), ("tp", 1, 1))
    ]


def _labelled(predictions: DataFrame, *keep: str) -> DataFrame:
    return predictions.select(
        *keep, checked_label("pred").alias("_pred"), checked_label("target").alias("_target")
    )


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """``pred, actual0, actual1``: a row per predicted class, a column per actual class."""
    cells = _labelled(predictions).agg(*_cells())
    rows = F.array(
        F.struct(F.lit(0).alias("pred"), F.col("tn").alias("actual0"), F.col("fn").alias("actual1")),
        F.struct(F.lit(1).alias("pred"), F.col("fp").alias("actual0"), F.col("tp").alias("actual1")),
    )
    return cells.select(F.inline(rows))


def accuracy(predictions: DataFrame) -> DataFrame:
    hit = (F.col("_pred") == F.col("_target")).cast("double")
    return _labelled(predictions).agg(F.avg(hit).alias("accuracy"))


def eval_report(predictions: DataFrame, by: str = "run_id") -> DataFrame:
    """``run_id, accuracy, tn, fn, fp, tp``: one row per run."""
    cells = _labelled(predictions, by).groupBy(by).agg(*_cells())
    share = (F.col("tn") + F.col("tp")) / (
        F.col("tn") + F.col("fn") + F.col("fp") + F.col("tp")
    )
    return cells.select(by, share.alias("accuracy"), "tn", "fn", "fp", "tp")
