"""Sparse long-form features: one row per post and non-zero feature.

Feature names: ``w:<term>``, ``kw:<keyword>`` (``kw`` for no keyword), ``loc``, ``url``, and
``1``, which every post has with value 1 and which carries priors and biases.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderpost.functions import patterns as P
from cinderpost.functions import text as X
from cinderpost.operators import tokens as K
from cinderpost.operators.lookup import keyed_lookup
from cinderpost.operators.unroll import unroll_structs, unroll_values
from cinderpost.session import stage

BIAS = "1"
WORD = "w:"
FEATURE = "struct<feature:string,value:double>"
LAYOUT = "_features"


def carried(df: DataFrame, *names: str) -> list[str]:
    """Those of ``names`` that ``df`` has; posts to be scored need no ``target``."""
    return [name for name in names if name in df.columns]


def term_frequency(tokenized: DataFrame) -> DataFrame:
    """``id, term, tf``; counted inside each row."""
    counted = X.term_counts(tokenized.select("id", "tokens"), "tokens", "counts")
    return unroll_structs(counted, ["id"], "counts", "term")


def term_binary(tokenized: DataFrame) -> DataFrame:
    """``id, term`` for every term a post holds."""
    return unroll_values(tokenized, ["id"], F.array_distinct("tokens"), "term")


def log_weight(tf: Column) -> Column:
    return 1.0 + F.log10(tf)


def log_tf(tokenized: DataFrame) -> DataFrame:
    """``id, term, log_tf``."""
    counts = term_frequency(tokenized)
    return counts.select("id", "term", log_weight(F.col("tf")).alias("log_tf"))


def document_frequency(tokenized: DataFrame) -> DataFrame:
    """``term, df``; counts are combined before the shuffle."""
    return term_binary(tokenized).groupBy("term").agg(F.count("*").alias("df"))


def idf(tokenized: DataFrame) -> DataFrame:
    """``term, df, idf`` with ``idf = log10(D) - log10(df)``, no smoothing."""
    n_docs = tokenized.agg(F.count("*").alias("n")).scalar()
    return document_frequency(tokenized).withColumn("idf", F.log10(n_docs) - F.log10("df"))


@dataclass
class IdfModel:
    """IDF of the training posts, applicable to any posts; other terms are dropped."""

    table: DataFrame

    @staticmethod
    def fit(train: DataFrame) -> IdfModel:
        return IdfModel(stage(idf(train), "idf"))

    def transform(self, tokenized: DataFrame) -> DataFrame:
        """``id, term, tfidf``."""
        found = keyed_lookup(log_tf(tokenized), self.table, "term", "inner", support="df")
        return found.select("id", "term", (F.col("log_tf") * F.col("idf")).alias("tfidf"))


def _feature(name: Column, value: Column) -> Column:
    return F.struct(name.alias("feature"), value.cast("double").alias("value")).cast(FEATURE)


def keyword_feature(keyword: Column) -> Column:
    return F.coalesce(F.concat(F.lit("kw:"), keyword), F.lit("kw"))


def keyword_onehot(posts: DataFrame) -> DataFrame:
    """``id, feature, value``: one row per post."""
    return posts.select(
        "id", keyword_feature(F.col("keyword")).alias("feature"), F.lit(1.0).alias("value")
    )


def with_layout(prepared: DataFrame) -> DataFrame:
    """Add all features of a post as one array, which every pass over features unrolls."""
    rows = X.term_counts(prepared, "tokens", "counts")
    words = F.transform(
        "counts", lambda c: _feature(F.concat(F.lit(WORD), c["term"]), c["tf"])
    )
    others = F.filter(
        F.array(
            _feature(F.lit(BIAS), F.lit(1)),
            _feature(F.lit("loc"), F.col("loc")),
            _feature(F.lit("url"), F.col("url")),
            _feature(keyword_feature(F.col("keyword")), F.lit(1)),
        ),
        lambda f: f["value"] > 0,
    )
    return rows.withColumn(LAYOUT, F.concat(words, others)).drop("counts")


def with_features(prepared: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``id``, the ``keep`` columns that there are, ``feature, value``; words carry their term
    frequency.

    All features of a post are laid out inside its row and then unrolled: no shuffle, and
    every post has at least its bias row. Posts that come ``with_layout`` are only unrolled.
    """
    keep = tuple(carried(prepared, *keep))
    rows = prepared if LAYOUT in prepared.columns else with_layout(prepared)
    return unroll_structs(rows, ["id", *keep], LAYOUT, "feature")


def is_word(feature: Column) -> Column:
    return feature.startswith(WORD)


def weigh(feature: Column, value: Column, weighting: str, idf_value: Column | None = None):
    """Value of a feature under a weighting; metadata features keep their own value."""
    K.check_option(weighting, P.WEIGHTINGS, "weighting")
    if weighting == "Frequency":
        return value
    if weighting == "Binary":
        return F.when(is_word(feature), 1.0).otherwise(value)
    return F.when(is_word(feature), log_weight(value) * idf_value).otherwise(value)


def feature_dictionary(rows: DataFrame) -> DataFrame:
    """``feature, df, idf`` of training rows; the columns of the feature matrix.

    ``loc`` and ``url`` are columns even when no post has them. The bias is not a column; its
    ``df`` is the number of posts.
    """
    always = rows.sparkSession.createDataFrame([("loc", 0), ("url", 0)], "feature string, df int")
    counts = (
        rows.select("feature", F.lit(1).alias("df"))
        .unionByName(always)
        .groupBy("feature")
        .agg(F.sum("df").alias("df"))
    )
    return counts


@dataclass
class FeatureModel:
    """Feature dictionary of the training posts for one weighting."""

    dictionary: DataFrame
    weighting: str

    def transform(self, prepared: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """``id``, ``keep`` columns, ``feature, value``; features unseen in training drop out."""
        rows = with_features(prepared, keep)
        found = keyed_lookup(rows, self.dictionary, "feature", "inner", support="df")
        value = weigh(F.col("feature"), F.col("value"), self.weighting, F.col("idf"))
        return found.withColumn("value", value).drop("idf")

    def transform_fitted(self, train: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """``transform`` of the posts that the dictionary was made of: all their features are in it."""
        if self.weighting == "TFIDF":
            return self.transform(train, keep)
        value = weigh(F.col("feature"), F.col("value"), self.weighting)
        return with_features(train, keep).withColumn("value", value)

    def transform_all(self, prepared: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """``id``, ``keep`` columns, ``feature, v``: values under every weighting, in their order."""
        found = keyed_lookup(with_features(prepared, keep), self.dictionary, "feature", "inner", support="df")
        values = [weigh(F.col("feature"), F.col("value"), name, F.col("idf")) for name in P.WEIGHTINGS]
        return found.withColumn("v", F.array(*values)).drop("idf", "value")

    def dims(self) -> DataFrame:
        """``n_terms, n_keywords, dims`` of the feature matrix."""
        name = F.col("feature")
        return self.dictionary.agg(
            F.count_if(is_word(name)).alias("n_terms"),
            F.count_if(name.startswith("kw")).alias("n_keywords"),
            F.count_if(name != BIAS).alias("dims"),
        )


@dataclass(frozen=True)
class FeatureBuilder:
    weighting: str = "Frequency"

    def __post_init__(self):
        K.check_option(self.weighting, P.WEIGHTINGS, "weighting")

    def fit(self, train: DataFrame, counts: DataFrame | None = None) -> FeatureModel:
        """The dictionary of ``train``; ``counts`` is a written table with its ``feature, df``, if known."""
        if counts is None:
            counts = stage(feature_dictionary(with_features(train)), "dictionary")
        counts = counts.select("feature", "df")
        n_docs = counts.filter(F.col("feature") == BIAS).select("df").scalar()
        inverse = F.when(is_word(F.col("feature")), F.log10(n_docs) - F.log10("df"))
        return FeatureModel(counts.withColumn("idf", inverse), self.weighting)
