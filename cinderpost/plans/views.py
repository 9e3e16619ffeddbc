"""Adapter views: posts, gold labels, training curves and predictions over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderpost.operators.ranking import rank_within
from cinderpost.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, keyword, location, text, target, split``; one post per document."""
    documents = spread(table(spark, sf_dir, "documents"), "doc_id")
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    doc, tag = F.col("doc_id"), F.col("source")
    link = F.coalesce(F.concat(F.lit(" "), F.col("url")), F.lit(""))
    return (
        documents.join(labels, "doc_id", "left")
        .join(pages, "doc_id", "left")
        .select(
            doc.alias("id"),
            F.when(doc % 7 == 0, None).otherwise(tag).alias("keyword"),
            F.when(doc % 3 == 0, None).otherwise(F.col("lang")).alias("location"),
            F.concat("text", link, F.lit(" I don't &amp; 2024 #"), tag, F.lit(" @user")).alias(
                "text"
            ),
            F.col("quality").alias("target"),
            F.when(doc % 10 < 7, "train").otherwise("test").alias("split"),
        )
    )


def labelled_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).filter(F.col("target").isNotNull())


def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts still without a label: ``id, text``."""
    documents = spread(table(spark, sf_dir, "documents"), "doc_id")
    return documents.select(F.col("doc_id").alias("id"), "text")


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``seq, text, choose_one``."""
    documents = spread(table(spark, sf_dir, "documents"), "doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return documents.join(labels, "doc_id").select(
        F.col("doc_id").alias("seq"),
        F.concat(F.lit("* "), F.col("text"), F.lit(" !")).alias("text"),
        F.when(F.col("toxic") == 1, "Can't Decide")
        .when(F.col("doc_id") % 2 == 0, "Relevant")
        .otherwise("Not Relevant")
        .alias("choose_one"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``run_id, epoch, test_acc``: each user's events in time order as one training curve."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        "ts",
        "event_id",
        F.col("value").alias("test_acc"),
        F.date_trunc("hour", "ts").alias("hour"),
    )
    ranked = rank_within(events, "run_id", "hour", ["ts", "event_id"], "epoch")
    return ranked.select("run_id", "epoch", "test_acc")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, pred, target`` from a fixed length rule standing in for a model."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("n_chars") > 500, 1).otherwise(0).alias("pred"),
        F.col("quality").alias("target"),
    )
