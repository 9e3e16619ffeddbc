"""Word vectors pooled per post, and a classifier over them."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderpost.functions import scoring as S
from cinderpost.functions import text as X
from cinderpost.operators.features import carried
from cinderpost.operators.lookup import keyed_lookup
from cinderpost.operators.unroll import unroll_structs, unroll_values
from cinderpost.session import stage
from cinderpost.sources.stages import StageStore


# A prime below 2^31: products of two numbers below it fit a long.
PRIME = (1 << 31) - 1


def random_embedding(vocab: DataFrame, size: int, seed: int = 7) -> DataFrame:
    """``term, vec``: standard normal numbers, always the same for a term and seed.

    Two numbers a, b from a digest of seed and term start a counter: x = (a + j b) mod PRIME for
    j = 0, 1, ..., squared twice with a and b added. Pairs of them give normal numbers by the
    cosine rule. A column ``df`` of the vocabulary, the posts of a term, is kept for later lookups.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), "term"))
    start = [F.conv(F.substring(digest, at, 15), 16, 10).cast("long") % PRIME for at in (1, 16)]
    drawn = vocab.select("term", *carried(vocab, "df"), *[x.alias(name) for x, name in zip(start, ("_a", "_b"))])
    return drawn.select("term", *carried(vocab, "df"), _normal(size)("_a", "_b").alias("vec"))


def _normal(size: int):
    @F.pandas_udf("array<float>")
    def draw(a: pd.Series, b: pd.Series) -> pd.Series:
        a, b = a.to_numpy(np.int64)[:, None], b.to_numpy(np.int64)[:, None]
        x = (a + np.arange(2 * size) * b) % PRIME
        x = (x * x + a) % PRIME
        u = ((x * x + b) % PRIME + 1) / float(PRIME + 1)
        normal = np.sqrt(-2.0 * np.log(u[:, ::2])) * np.cos(2.0 * math.pi * u[:, 1::2])
        return pd.Series(list(normal.astype(np.float32)))

    return draw


def pool_posts(tokenized: DataFrame, embedding: DataFrame) -> DataFrame:
    """``id, target, features``: mean vector of a post's tokens; ``target`` if there is one.

    ``embedding`` is any written ``term, vec`` table; a column ``df`` tells its frequent terms
    without a pass over the posts. A post without a known token gets zeros.
    """
    rows = unroll_values(tokenized, ["id"], "tokens", "term")
    support = "df" if "df" in embedding.columns else None
    found = keyed_lookup(rows, embedding, "term", "inner", support=support)
    kept = carried(tokenized, "target")
    least, size = embedding.agg(F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if least != size:
        raise ValueError(f"vectors have {least} to {size} numbers")
    # One sum a place keeps fixed-width buffers, which are added up in memory by post.
    places = range(size or 0)
    sums = [F.sum(F.get("vec", F.lit(i)).cast("double")).alias(f"_{i}") for i in places]
    pooled = found.groupBy("id").agg(F.count("vec").alias("_n"), *sums)
    mean = F.array(*[F.col(f"_{i}") / F.col("_n") for i in places]).cast("array<double>")
    zeros = F.array_repeat(F.lit(0.0), len(places))
    every = tokenized.select("id", *kept).join(pooled.select("id", mean.alias("_mean")), "id", "left")
    return every.select("id", *kept, array_to_vector(F.coalesce("_mean", zeros)).alias("features"))


def pool_vectors(vectors: DataFrame, group: str, vec: str) -> DataFrame:
    """``group, pos, mean_value``: mean vector of each group, one row per place."""
    mean = Summarizer.mean(array_to_vector(F.col(vec).cast("array<double>")))
    pooled = vectors.groupBy(group).agg(mean.alias("_mean"))
    return pooled.select(group, F.posexplode(vector_to_array("_mean")).alias("pos", "mean_value"))


BIAS = -1


def _table(spark: SparkSession, weights: list[float], bias: float) -> DataFrame:
    rows = [(BIAS, float(bias)), *((i, float(w)) for i, w in enumerate(weights))]
    return spark.createDataFrame(rows, "pos int, w double")


@dataclass
class SequenceModel:
    """Word vectors and a linear classifier over pooled vectors: tables, no learner's object.

    ``weights`` is ``pos, w``, as long as one vector; the bias stands at place -1.
    """

    embedding: DataFrame
    weights: DataFrame

    @staticmethod
    def fit(train: DataFrame, embedding: DataFrame) -> SequenceModel:
        pooled = stage(pool_posts(train, embedding), "pooled")
        learner = LogisticRegression(labelCol="target", maxIter=50, regParam=0.01)
        found = learner.fit(pooled)
        table = _table(train.sparkSession, found.coefficients.toArray().tolist(), found.intercept)
        return SequenceModel(embedding, stage(table, "sequence-weights"))

    def score(self, tokenized: DataFrame) -> DataFrame:
        """``id, target, p, pred`` of every post; ``target`` if there is one.

        The mean of a post's vectors times the weights is the mean of its terms' products, so a
        term becomes one number before any join, and no vector is shuffled.
        """
        places = self.weights.filter(F.col("pos") >= 0)
        weights = places.agg(F.array_sort(F.collect_list(F.struct("pos", "w"))).alias("ws")).select(
            F.transform("ws", lambda x: x["w"])
        ).scalar()
        bias = self.weights.filter(F.col("pos") == BIAS).select("w").scalar()
        products = F.zip_with("vec", "_ws", lambda v, w: v.cast("double") * w)
        terms = self.embedding.withColumn("_ws", weights).select(
            "term",
            *carried(self.embedding, "df"),
            F.aggregate(products, F.lit(0.0), lambda total, x: total + x).alias("_s"),
        )
        counted = X.term_counts(tokenized.select("id", "tokens"), "tokens", "counts")
        rows = unroll_structs(counted, ["id"], "counts", "term")
        support = "df" if "df" in self.embedding.columns else None
        found = keyed_lookup(rows, stage(terms, "term-scores"), "term", "inner", support=support)
        means = found.groupBy("id").agg((F.sum(F.col("_s") * F.col("tf")) / F.sum("tf")).alias("_z"))
        kept = carried(tokenized, "target")
        every = tokenized.select("id", *kept).join(means, "id", "left")
        p = S.sigmoid(F.coalesce("_z", F.lit(0.0)) + bias)
        return every.select("id", *kept, p.alias("p")).withColumn("pred", S.threshold(F.col("p")))

    def predict(self, tokenized: DataFrame) -> DataFrame:
        """``id, target, pred`` of every post; ``target`` if there is one."""
        return self.score(tokenized).drop("p")

    def save(self, store: StageStore, **facts) -> None:
        store.save(self.embedding, "sequence-embedding", **facts)
        store.save(self.weights, "sequence-weights", **facts)

    @staticmethod
    def load(store: StageStore, **facts) -> SequenceModel:
        return SequenceModel(store.load("sequence-embedding", **facts), store.load("sequence-weights", **facts))
