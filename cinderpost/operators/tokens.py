"""Token tables: one row per post with its token list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderpost.functions import patterns as P
from cinderpost.functions import text as X
from cinderpost.functions.porter import stem_column, stem_tokens
from cinderpost.operators import metadata as M
from cinderpost.operators.unroll import unroll_values


def check_option(value: str, allowed: tuple[str, ...], what: str) -> None:
    """Reject an unknown option before any Spark job starts."""
    if value not in allowed:
        raise ValueError(f"{what} must be one of {', '.join(allowed)}; got {value!r}")


def with_pieces(posts: DataFrame, legacy_stops: bool = False) -> DataFrame:
    """Add ``pieces``: the cleaned text split at blanks, without stop words."""
    split = posts.withColumn("_clean", X.clean_text(F.col("text"))).withColumn(
        "pieces", X.pieces(F.col("_clean"))
    )
    return X.remove_stop_words(split, "pieces", legacy_stops).drop("_clean")


def with_tokens(
    posts: DataFrame, stemming: str = "NoStem", legacy_stops: bool = False
) -> DataFrame:
    """Add ``tokens``. Every step works inside a row, so nothing is shuffled."""
    check_option(stemming, P.STEMMING, "stemming")
    tokens = (
        with_pieces(posts, legacy_stops)
        .withColumn("tokens", X.tokenize(F.array_join("pieces", " ")))
        .withColumn("tokens", X.split_contractions(F.col("tokens")))
        .drop("pieces")
    )
    if stemming == "Stem":
        tokens = tokens.withColumn("tokens", stem_tokens(F.col("tokens")))
    return tokens


def prepare(
    posts: DataFrame, stemming: str = "NoStem", legacy_stops: bool = False
) -> DataFrame:
    """Posts with ``loc``, ``url`` and ``tokens`` in place of the raw text and location."""
    described = M.url_count(M.location_flag(posts))
    return with_tokens(described, stemming, legacy_stops).drop("text", "location")


def token_corpus(
    posts: DataFrame, legacy_stops: bool = False, variants: tuple[str, ...] = P.STEMMING
) -> DataFrame:
    """``id, split, variant, tokens`` for the variants asked for; the text is tokenized once."""
    for variant in variants:
        check_option(variant, P.STEMMING, "stemming")
    rows = with_tokens(posts, "NoStem", legacy_stops).select("id", "split", "tokens")
    if "Stem" in variants:
        rows = rows.withColumn("_stems", stem_tokens(F.col("tokens")))
    columns = {"NoStem": "tokens", "Stem": "_stems"}
    made = [
        F.struct(F.lit(v).alias("variant"), F.col(columns[v]).alias("tokens")) for v in variants
    ]
    return rows.select("id", "split", F.inline(F.array(*made)))


def distinct_tokens(tokenized: DataFrame) -> DataFrame:
    """``token``; repeats inside a post are dropped before the shuffle."""
    return unroll_values(tokenized, [], F.array_distinct("tokens"), "token").distinct()


def stem_table(tokenized: DataFrame) -> DataFrame:
    """``token, stem`` for every distinct token."""
    return distinct_tokens(tokenized).withColumn("stem", stem_column(F.col("token")))


def flatten(tokenized: DataFrame) -> DataFrame:
    """``id, pos, token``, one row per occurrence."""
    rows = tokenized.select("id", F.posexplode_outer("tokens").alias("pos", "token"))
    return rows.filter(F.col("pos").isNotNull())


def max_length(tokenized: DataFrame) -> DataFrame:
    return tokenized.agg(F.max(F.size("tokens")).alias("max_len"))
