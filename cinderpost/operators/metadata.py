"""Keyword, location and link columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderpost.functions import text as X
from cinderpost.operators.lookup import keyed_lookup
from cinderpost.operators.ranking import dense_index

# Id of a keyword that the training posts do not hold.
UNKNOWN = -1


def location_flag(posts: DataFrame) -> DataFrame:
    return posts.withColumn("loc", X.has_location(F.col("location")))


def url_count(posts: DataFrame) -> DataFrame:
    return posts.withColumn("url", F.coalesce(X.url_count(F.col("text")), F.lit(0)))


def keyword_index(train: DataFrame) -> DataFrame:
    """``keyword, keywd``: distinct keywords numbered in order; null is a keyword, the first."""
    return dense_index(train.select("keyword").distinct(), "keyword", "keywd")


def _never_null(keyword: Column) -> Column:
    return F.coalesce(F.concat(F.lit("k"), keyword), F.lit(""))


def keyword_encode(posts: DataFrame, index: DataFrame, unseen: str = "unknown") -> DataFrame:
    """Add ``keywd``. ``unseen="error"`` fails on a keyword that ``index`` does not hold."""
    if unseen not in ("unknown", "error"):
        raise ValueError("unseen must be 'unknown' or 'error'")
    ids = index.select(_never_null(F.col("keyword")).alias("_key"), "keywd")
    found = keyed_lookup(
        posts.withColumn("_key", _never_null(F.col("keyword"))), ids, "_key"
    ).drop("_key")
    if unseen == "error":
        missing = F.raise_error(F.concat(F.lit("unseen keyword: "), F.col("keyword")))
        return found.withColumn("keywd", F.coalesce("keywd", missing.cast("long")))
    return found.withColumn("keywd", F.coalesce("keywd", F.lit(UNKNOWN)))
