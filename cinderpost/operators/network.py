"""Logistic and one-hidden-layer sigmoid networks, trained on squared error.

Training is full-batch descent: every step sums the gradient over all posts, so the weights
depend on the posts alone and not on how many there are, how they are spread or in what order
they come. Mini-batches of the reference kind are a sequence over all posts and are left out.

The weights are a table ``feature, w``; they never pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from cinderpost.functions import scoring as S
from cinderpost.operators import history as H
from cinderpost.operators.features import BIAS, carried
from cinderpost.operators.lookup import PlacedRows, keyed_lookup, placed_rows
from cinderpost.session import discard, stage

# Name that stands beside the features in the weight table: the output layer and its bias.
OUTPUT = "2"
HISTORY = "run_id string, epoch int, loss double, train_acc double, test_acc double"


@dataclass(frozen=True)
class Settings:
    """``hidden=0`` is logistic regression. A round is one step over all posts.

    Without ``rate`` it is 0.1, or 0.5 with a hidden layer. Weights start uniformly in
    [0, ``start``). Long posts need a small ``start``: hundreds of weights near one half add up
    to a score where the sigmoid has no slope. The early stop looks back ``window`` rounds.
    """

    hidden: int = 0
    rate: float | None = None
    rounds: int = 10_000
    window: int = 100
    seed: int = 7
    start: float = 1.0

    @property
    def step(self) -> float:
        return self.rate if self.rate is not None else (0.5 if self.hidden else 0.1)


def _uniform(seed: Column, *parts: Column) -> Column:
    """Repeatable uniform number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts, seed), F.lit(1 << 30)) / float(1 << 30)


def initial_weights(features: DataFrame, settings: Settings) -> DataFrame:
    """``feature, w`` with uniform starting values for ``feature`` rows and the output layer."""
    output = features.sparkSession.createDataFrame([(OUTPUT,)], "feature string")
    names = features.unionByName(output) if settings.hidden else features
    width = F.when(F.col("feature") == OUTPUT, settings.hidden + 1).otherwise(
        max(settings.hidden, 1)
    )
    return names.select(
        "feature",
        F.transform(
            F.sequence(F.lit(1), width),
            lambda i: settings.start * _uniform(F.lit(settings.seed), F.col("feature"), i),
        ).alias("w"),
    )


def _sums(hidden: int) -> list[Column]:
    """The weighted sum of every unit, as columns _z0, _z1, ..."""
    units = range(max(hidden, 1))
    value = F.coalesce(F.col("value"), F.lit(0.0))
    return [F.sum(value * F.coalesce(F.get("w", F.lit(i)), F.lit(0.0))).alias(f"_z{i}") for i in units]


def _activated(sums: DataFrame, weights: DataFrame, hidden: int) -> DataFrame:
    """Add ``p``, and with a hidden layer ``_inner`` (its activations) and ``_out``."""
    if not hidden:
        return sums.withColumn("p", S.sigmoid(F.col("_z0")))
    last = weights.filter(F.col("feature") == OUTPUT).select("w").scalar()
    inner = F.array(*[S.sigmoid(F.col(f"_z{i}")) for i in range(hidden)])
    placed = sums.withColumn("_out", last).withColumn("_inner", inner)
    z = F.get("_out", F.lit(hidden))
    for i in range(hidden):
        z = z + F.get("_out", F.lit(i)) * F.get("_inner", F.lit(i))
    return placed.withColumn("p", S.sigmoid(z))


@dataclass
class NetworkModel:
    weights: DataFrame
    hidden: int
    history: DataFrame | None = None

    def score(self, rows: DataFrame) -> DataFrame:
        """``id, target, p, pred`` of written rows ``id, feature, value``.

        ``target`` is carried along if there is one. Every post with a row has a score;
        features without a weight count as weight 0. A column ``df`` of the weights, the rows of
        a feature, tells the frequent ones without a pass over the rows.
        """
        first = self.weights.filter(F.col("feature") != OUTPUT)
        support = "df" if "df" in first.columns else None
        found = keyed_lookup(rows, first, "feature", support=support)
        kept = carried(rows, "target")
        sums = found.groupBy("id").agg(*[F.max(c).alias(c) for c in kept], *_sums(self.hidden))
        scored = _activated(sums, self.weights, self.hidden).select("id", *kept, "p")
        return scored.withColumn("pred", S.threshold(F.col("p")))


def gradient_step(
    rows: PlacedRows, weights: DataFrame, hidden: int, rate: float
) -> tuple[DataFrame, Row]:
    """Weights after one step down the mean squared error of all posts, and statistics before it.

    The statistics are one row: posts, loss and the percentage of right classes. Scores are sums per post where the rows lie; only the sums of rare features are shuffled
    when the weights are too large to broadcast. Posts then carry their slope back to their
    rows, which are bucketed by post, and gradients are summed per feature, in part before the
    shuffle. The weights are written.
    """
    first = weights.filter(F.col("feature") != OUTPUT)
    sums = rows.sums(first, "feature", _sums(hidden)).join(rows.labels, "id")
    p, y = F.col("p"), F.col("target")
    slope = 2.0 * (p - y) * p * (1.0 - p)
    back = (
        F.transform(
            F.arrays_zip(F.slice("_out", 1, hidden).alias("o"), F.col("_inner").alias("a")),
            lambda u: F.col("_slope") * u["o"] * u["a"] * (1.0 - u["a"]),
        )
        if hidden
        else F.array("_slope")
    )
    extra = ["_inner"] if hidden else []
    scored = _activated(sums, weights, hidden).withColumn("_slope", slope)
    posts = stage(scored.select("id", "target", "p", "_slope", back.alias("_back"), *extra), "scored")
    hit = ((p > 0.5) == (y == 1)).cast("double")
    facts = posts.agg(
        F.count("*").alias("n"), F.avg((p - y) ** 2).alias("loss"), (100.0 * F.avg(hit)).alias("hits")
    ).first()
    units = range(max(hidden, 1))
    gradients = (
        rows.by_post.select("id", "feature", "value")
        .join(posts.select("id", "_back"), "id")
        .groupBy("feature")
        .agg(F.array(*[F.sum(F.col("value") * F.get("_back", F.lit(i))) for i in units]).alias("_g"))
    )
    if hidden:
        last = [F.sum(F.col("_slope") * F.get("_inner", F.lit(i))) for i in range(hidden)]
        gradients = gradients.unionByName(
            posts.agg(F.array(*last, F.sum("_slope")).alias("_g")).select(F.lit(OUTPUT).alias("feature"), "_g")
        )
    moved = weights.join(gradients, "feature", "left").select(
        "feature",
        F.when(F.col("_g").isNull(), F.col("w"))
        .otherwise(F.zip_with("w", "_g", lambda w, g: w - rate * g / facts["n"]))
        .alias("w"),
    )
    after = stage(moved, "weights")
    discard(posts)
    return after, facts


@contextmanager
def training_rows(
    rows: DataFrame, hidden: int, broadcast_bytes: int | None = None
) -> Iterator[PlacedRows]:
    """Rows ``id, target, feature, value`` laid out for many steps; labels outside 0/1 fail."""
    checked = rows.withColumn("target", S.checked_label("target"))
    width = max(hidden, 1)
    with placed_rows(checked, "id", "feature", "target", BIAS, width, broadcast_bytes) as placed:
        yield placed


def descend(
    rows: DataFrame,
    weights: DataFrame,
    hidden: int,
    rate: float,
    steps: int,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """``feature, w`` after some steps from given weights (written, ``w`` an array)."""
    with training_rows(rows, hidden, broadcast_bytes) as placed:
        return take_steps(placed, weights, hidden, rate, steps)


def take_steps(placed: PlacedRows, weights: DataFrame, hidden: int, rate: float, steps: int) -> DataFrame:
    """``feature, w`` after some steps over rows that are laid out."""
    given = weights
    for _ in range(steps):
        after, _ = gradient_step(placed, weights, hidden, rate)
        if weights is not given:
            discard(weights)
        weights = after
    return weights


def _accuracy(model: NetworkModel, validation: DataFrame) -> float:
    hit = (F.col("pred") == F.col("target")).cast("double")
    share = model.score(validation).agg(F.avg(hit)).first()[0]
    if share is None:
        raise ValueError("there are no validation posts to choose a round on")
    return 100.0 * share


def fit(
    train: DataFrame, validation: DataFrame, settings: Settings, run_id: str = "run"
) -> NetworkModel:
    """Train on written rows ``id, target, feature, value`` that include the bias rows.

    The best round by ``validation`` accuracy is kept, and training stops when a round falls
    below the ``window - 1`` rounds before it. Of each round the driver reads one row of
    statistics and the validation accuracy; tables of earlier rounds are deleted.
    """
    names = train.select("feature").distinct()
    best = weights = stage(initial_weights(names, settings), "weights")
    curve: list[tuple] = []
    with training_rows(train, settings.hidden) as placed:
        for round_no in range(1, settings.rounds + 1):
            after, facts = gradient_step(placed, weights, settings.hidden, settings.step)
            if weights is not best:
                discard(weights)
            weights = after
            accuracy = _accuracy(NetworkModel(weights, settings.hidden), validation)
            earlier = [row[-1] for row in curve]
            curve.append((run_id, round_no, facts["loss"], facts["hits"], accuracy))
            if H.is_kept(earlier, accuracy):
                if best is not weights:
                    discard(best)
                best = weights
            if H.stops(earlier, accuracy, settings.window):
                break
    if weights is not best:
        discard(weights)
    history = train.sparkSession.createDataFrame(curve, HISTORY)
    return NetworkModel(best, settings.hidden, history)
