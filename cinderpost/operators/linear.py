"""Linear scores with a sigmoid, and full-batch gradient steps on the squared error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderpost.functions import scoring as S
from cinderpost.operators import network
from cinderpost.operators.features import carried
from cinderpost.operators.lookup import keyed_lookup
from cinderpost.session import stage


def logistic_score(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """``id, target, p, pred`` of rows ``id, feature, value``; ``target`` only if there is one.

    ``weights`` is ``feature, w``; the bias is the weight of the bias feature. Features
    without a weight count as weight 0, so every post keeps a score. A column ``df``, the rows of
    a feature, tells the frequent ones without a pass over the rows.
    """
    support = "df" if "df" in weights.columns else None
    found = keyed_lookup(rows, weights, "feature", support=support)
    kept = carried(rows, "target")
    z = F.sum(F.col("value") * F.coalesce("w", F.lit(0.0)))
    scored = found.groupBy("id").agg(*[F.max(c).alias(c) for c in kept], S.sigmoid(z).alias("p"))
    return scored.withColumn("pred", S.threshold(F.col("p")))


def descend(
    rows: DataFrame,
    weights: DataFrame,
    rate: float,
    steps: int,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """``feature, w`` after full-batch steps over written rows ``id, target, feature, value``.

    Every feature of the rows has a weight; those that ``weights`` leaves out start from 0.
    """
    with network.training_rows(rows, 0, broadcast_bytes) as placed:
        start = placed.counts.join(weights.select("feature", "w"), "feature", "left")
        first = stage(start.select("feature", F.array(F.coalesce("w", F.lit(0.0))).alias("w")), "weights")
        found = network.take_steps(placed, first, 0, rate, steps)
    return found.select("feature", F.get("w", F.lit(0)).alias("w"))


def mse_gradient_step(rows: DataFrame, weights: DataFrame, rate: float) -> DataFrame:
    """``feature, w`` after one step down the mean squared error over all posts."""
    return descend(rows, weights, rate, 1)
