"""Label recovery: posts take the label of gold posts with the same letters and digits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderpost.functions import text as X
from cinderpost.operators.lookup import keyed_lookup
from cinderpost.session import stage

UNMATCHED = -1


def digest(text: Column) -> Column:
    """Fixed-length stand-in for the match key, so that shuffles do not carry whole texts."""
    return F.sha2(X.match_key(text), 256)


def category_label(category: Column) -> Column:
    """1 for Relevant, 0 for Not Relevant, null for any other category."""
    return F.when(category == "Relevant", 1).when(category == "Not Relevant", 0)


def gold_keys(gold: DataFrame, drop_empty: bool = False) -> DataFrame:
    """``key, seq, label`` of the gold posts that carry a label."""
    rows = gold.select(
        digest(F.col("text")).alias("key"),
        "seq",
        category_label(F.col("choose_one")).alias("label"),
        (X.match_key(F.col("text")) == "").alias("empty"),
    ).filter(F.col("label").isNotNull())
    if drop_empty:
        rows = rows.filter(~F.col("empty"))
    return rows.drop("empty")


def gold_labels(gold: DataFrame, drop_empty: bool = False) -> DataFrame:
    """``key, label``: per key the label of the last gold post in ``seq`` order."""
    return (
        gold_keys(gold, drop_empty).groupBy("key").agg(F.max_by("label", "seq").alias("label"))
    )


def label_match(posts: DataFrame, gold: DataFrame, drop_empty: bool = False) -> DataFrame:
    """``id, target``: the recovered label, -1 where no gold post matches.

    Gold has one row per key before the join, so the join never multiplies rows; copies of
    one post may be as many as they like.
    """
    keyed = stage(posts.select("id", digest(F.col("text")).alias("key")), "post-keys")
    found = keyed_lookup(keyed, stage(gold_labels(gold, drop_empty), "gold-keys"), "key")
    return found.select("id", F.coalesce("label", F.lit(UNMATCHED)).alias("target"))


def add_labels(posts: DataFrame, matched: DataFrame) -> DataFrame:
    """Posts with the recovered ``target`` column, joined on ``id``."""
    return posts.join(matched, "id")


def unmatched(posts: DataFrame, gold: DataFrame) -> DataFrame:
    """``id`` of the posts no labelled gold post matches."""
    return label_match(posts, gold).filter(F.col("target") == UNMATCHED).select("id")


def label_conflicts(gold: DataFrame) -> DataFrame:
    """``key, n_zero, n_one`` of keys whose gold posts carry both labels."""
    return (
        gold_keys(gold)
        .groupBy("key")
        .agg(
            F.count_if(F.col("label") == 0).alias("n_zero"),
            F.count_if(F.col("label") == 1).alias("n_one"),
        )
        .filter((F.col("n_zero") > 0) & (F.col("n_one") > 0))
    )
