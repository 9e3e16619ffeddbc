"""Model selection and early stop over training curves ``run_id, epoch, test_acc``.

``is_kept`` and ``stops`` are the rules for one round of a run in progress; ``best_checkpoint``
and ``early_stop`` apply the same rules to tables of finished runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def is_kept(earlier: list[float], value: float) -> bool:
    """Whether a model is kept: it beats every earlier round and zero."""
    return value > max([0.0, *earlier])


def stops(earlier: list[float], value: float, window: int) -> bool:
    """Whether a run ends: from round ``window`` on, below the ``window - 1`` rounds before."""
    return len(earlier) + 1 >= window and value < min(earlier[-(window - 1) :])


def best_checkpoint(history: DataFrame) -> DataFrame:
    """``run_id, epoch, test_acc`` of the model kept last.

    A model is kept when it beats every earlier epoch and zero, so the last one kept is the
    first epoch with the top value. A plain aggregation finds it, whatever the run's length.
    """
    top = F.max(F.struct("test_acc", (-F.col("epoch")).alias("back"))).alias("top")
    return (
        history.filter(F.col("test_acc") > 0)
        .groupBy("run_id")
        .agg(top)
        .select(
            "run_id",
            (-F.col("top.back")).alias("epoch"),
            F.col("top.test_acc").alias("test_acc"),
        )
    )


def early_stop(history: DataFrame, window: int) -> DataFrame:
    """``run_id, stop_epoch``: first epoch from ``window`` on that is below the ``window - 1``
    values before it; null when the run never stops.

    Long runs are cut into blocks; each block also gets the few epochs before it, so one run
    spreads over many tasks.
    """
    if window < 2:
        raise ValueError("window must be at least 2")
    span = max(1024, 4 * window)
    block = F.floor(F.col("epoch") / span)
    # The next block needs the last window - 1 epochs of this one.
    lead_in = F.when(F.col("epoch") % span > span - window, F.array(block, block + 1)).otherwise(
        F.array(block)
    )
    spread = history.select(
        "run_id", "epoch", "test_acc", block.alias("_own"), F.explode(lead_in).alias("_block")
    )
    before = Window.partitionBy("run_id", "_block").orderBy("epoch")
    floor = F.min("test_acc").over(before.rowsBetween(-(window - 1), -1))
    stops = (F.col("_block") == F.col("_own")) & (F.col("epoch") >= window) & (
        F.col("test_acc") < F.col("_floor")
    )
    return (
        spread.withColumn("_floor", floor)
        .groupBy("run_id")
        .agg(F.min(F.when(stops, F.col("epoch"))).alias("stop_epoch"))
    )


def epoch_metrics(scored: DataFrame) -> DataFrame:
    """``epoch, loss, train_acc, test_acc`` from ``epoch, split, batch, p, pred, target``.

    ``loss`` is the mean over training batches of the mean squared error in the batch.
    """
    error = (F.col("p") - F.col("target")) ** 2
    hit = (F.col("pred") == F.col("target")).cast("int")
    batches = scored.groupBy("epoch", "split", "batch").agg(
        F.avg(error).alias("mse"), F.sum(hit).alias("hits"), F.count("*").alias("n")
    )

    def of(split, value):
        return F.when(F.col("split") == split, F.col(value))

    def share(split):
        return 100.0 * F.sum(of(split, "hits")) / F.sum(of(split, "n"))

    return batches.groupBy("epoch").agg(
        F.avg(of("train", "mse")).alias("loss"),
        share("train").alias("train_acc"),
        share("test").alias("test_acc"),
    )
