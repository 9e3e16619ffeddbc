"""Multinomial naive Bayes over long-form features.

Training is one aggregation per feature for all weightings together: a TF-IDF sum per class
is ``idf * sum(1 + log10 tf)``, and ``idf`` needs only the row count of the same group. The
bias row of every post makes its group hold the class sizes, so the prior needs no pass of
its own, and in scoring the prior is simply the weight of the bias row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderpost.functions import patterns as P
from cinderpost.functions.scoring import checked_label
from cinderpost.operators import features as E
from cinderpost.operators.lookup import keyed_lookup
from cinderpost.operators.tokens import check_option
from cinderpost.session import stage

LABELS = (0, 1)


def class_sums(rows: DataFrame) -> DataFrame:
    """``feature, df`` and per class ``n`` (rows), ``s`` (values), ``l`` (log-weighted values).

    ``rows`` is the result of ``with_features`` with the ``target`` column.
    """
    always = rows.sparkSession.createDataFrame(
        [(name, 0.0, label) for name in ("loc", "url") for label in LABELS],
        "feature string, value double, target int",
    )
    present = F.col("value") > 0
    sums = [F.count_if(present).alias("df")]
    for label in LABELS:
        mine = present & (F.col("target") == label)
        sums += [
            F.count_if(mine).alias(f"n{label}"),
            F.coalesce(F.sum(F.when(mine, F.col("value"))), F.lit(0.0)).alias(f"s{label}"),
            F.coalesce(
                F.sum(F.when(mine, E.log_weight(F.col("value")))), F.lit(0.0)
            ).alias(f"l{label}"),
        ]
    return (
        rows.select("feature", "value", "target").unionByName(always).groupBy("feature").agg(*sums)
    )


def _class_value(weighting: str, label: int, idf: Column) -> Column:
    """Summed value of a feature over the posts of a class."""
    raw, word = F.col(f"s{label}"), E.is_word(F.col("feature"))
    if weighting == "Binary":
        return F.when(word, F.col(f"n{label}").cast("double")).otherwise(raw)
    if weighting == "TFIDF":
        return F.when(word, F.col(f"l{label}") * idf).otherwise(raw)
    return raw


@dataclass
class NaiveBayesModel:
    """``sums`` holds the class sums; parameters are projections of it."""

    sums: DataFrame

    def prior(self) -> DataFrame:
        """``label, log_prior``: log share of the class, not smoothed."""
        classes = F.array(
            *(F.struct(F.lit(c).alias("label"), self._log_prior(c).alias("log_prior")) for c in LABELS)
        )
        return self._bias().select(F.inline(classes))

    def likelihood(self, weighting: str) -> DataFrame:
        """``feature, ll0, ll1`` with add-one smoothing over all feature columns."""
        check_option(weighting, P.WEIGHTINGS, "weighting")
        return self._likelihoods((weighting,)).select(
            "feature", *(F.col(f"{weighting}.ll{c}") for c in LABELS)
        )

    def parameters(self, weightings: tuple[str, ...]) -> DataFrame:
        """``feature, df, idf`` and a column ``struct<ll0, ll1>`` per weighting.

        The bias row carries the log priors.
        """
        priors = F.struct(*(self._log_prior(c).alias(f"ll{c}") for c in LABELS))
        bias = self._bias().select(
            "feature",
            "df",
            F.lit(None).cast("double").alias("idf"),
            *(priors.alias(w) for w in weightings),
        )
        return self._likelihoods(weightings).unionByName(bias)

    @staticmethod
    def _log_prior(label: int) -> Column:
        return F.log(f"n{label}") - F.log("df")

    def _bias(self) -> DataFrame:
        return self.sums.filter(F.col("feature") == E.BIAS)

    def _likelihoods(self, weightings: tuple[str, ...]) -> DataFrame:
        n_docs = self._bias().select("df").scalar()
        idf = F.when(E.is_word(F.col("feature")), F.log10(n_docs) - F.log10("df"))
        columns = self.sums.filter(F.col("feature") != E.BIAS).withColumn("idf", idf)
        values = {
            (w, c): _class_value(w, c, F.col("idf")) for w in weightings for c in LABELS
        }
        totals = columns.agg(
            F.struct(
                *((F.sum(v) + F.count("*")).alias(f"{w}{c}") for (w, c), v in values.items())
            )
        ).scalar()

        def smoothed(w: str, c: int) -> Column:
            return F.log(values[w, c] + 1.0) - F.log(totals[f"{w}{c}"])

        return columns.select(
            "feature",
            "df",
            "idf",
            *(F.struct(*(smoothed(w, c).alias(f"ll{c}") for c in LABELS)).alias(w) for w in weightings),
        )


def fit(prepared: DataFrame) -> NaiveBayesModel:
    """Train on prepared posts with a ``target``; serves every weighting."""
    labelled = prepared.withColumn("target", checked_label("target"))
    rows = E.with_features(labelled, keep=("target",))
    return NaiveBayesModel(stage(class_sums(rows), "class-sums"))


def score(
    prepared: DataFrame, model: NaiveBayesModel, weightings: tuple[str, ...]
) -> DataFrame:
    """``id, target, weighting, score0, score1``; all weightings share one join.

    ``target`` is carried along if the posts have one. A post without known tokens is scored by
    its other features and the prior.
    """
    for weighting in weightings:
        check_option(weighting, P.WEIGHTINGS, "weighting")
    rows = E.with_features(prepared, keep=("target",))
    parameters = stage(model.parameters(weightings), "parameters")
    found = keyed_lookup(rows, parameters, "feature", "inner", support="df")
    sums = []
    for weighting in weightings:
        x = E.weigh(F.col("feature"), F.col("value"), weighting, F.col("idf"))
        sums += [
            F.sum(F.col(weighting)[f"ll{c}"] * x).alias(f"{weighting}{c}") for c in LABELS
        ]
    kept = E.carried(rows, "target")
    wide = found.groupBy("id").agg(*[F.max(c).alias(c) for c in kept], *sums)
    per_weighting = F.array(
        *(
            F.struct(
                F.lit(w).alias("weighting"),
                F.col(f"{w}0").alias("score0"),
                F.col(f"{w}1").alias("score1"),
            )
            for w in weightings
        )
    )
    return wide.select("id", *kept, F.inline(per_weighting))


def predict(scores: DataFrame) -> DataFrame:
    """Class of the larger score; equal scores give class 0."""
    return scores.withColumn("pred", F.when(F.col("score1") > F.col("score0"), 1).otherwise(0))
