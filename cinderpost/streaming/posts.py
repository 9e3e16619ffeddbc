"""Posts arriving as files: the stateless steps over a streaming DataFrame.

Cleaning, metadata columns and tokens are computed inside a row, so the batch functions apply
unchanged; scoring joins each micro-batch to a stored model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cinderpost.operators.tokens import prepare
from cinderpost.plans.experiments import Trained
from cinderpost.session import workspace
from cinderpost.sources.posts import LABELLED_POST, POST, csv_reader


def read_post_stream(spark: SparkSession, folder: str, labelled: bool = False) -> DataFrame:
    return csv_reader(spark.readStream, LABELLED_POST if labelled else POST).csv(folder)


def prepare_stream(posts: DataFrame, stemming: str = "NoStem") -> DataFrame:
    return prepare(posts, stemming)


def score_stream(posts: DataFrame, model: Trained, out: str, checkpoint: str) -> StreamingQuery:
    """Write ``run_id, id, pred`` (and ``target``, if posts have one) of arriving posts as parquet.

    Each micro-batch replaces its own folder, so a repeated batch leaves no doubles.
    """

    def write(batch: DataFrame, batch_no: int) -> None:
        prepared = prepare(batch, model.experiment.stemming, model.experiment.legacy_stops)
        with workspace():
            model.predict(prepared).write.mode("overwrite").parquet(f"{out}/batch={batch_no}")

    return (
        posts.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
