"""Many logistic and one-hidden-layer runs trained together, by quasi-Newton or by plain steps.

Runs over the same posts share their rows: a row holds a feature's value under every weighting,
the weight table holds the weights of all runs side by side, so one scan serves them all.

Every gradient is a sum of rows, so it is known by the slopes of the posts it was made from, and
so is every step. Slopes, and what a step changes in a post's sums, are kept by post, of which
there are far fewer than features; inner products of gradients and steps are sums of products of
the two. A round goes through the rows once, to the features and back; weights by feature are made
once, at the end.

Rows are packed by feature (``blocks``). What passes the driver, inner products, output layers and
some sums by run aside, are the numbers of one group of units for every post, which the broadcast
size holds. Where it doesn't hold one unit for every post, rows stay rows and are joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderpost.functions import scoring as S
from cinderpost.operators import history as H
from cinderpost.operators.blocks import Blocks, ByPost, gathered, pack, small_batches
from cinderpost.operators.features import BIAS, carried
from cinderpost.operators import lookup
from cinderpost.operators.lookup import PlacedRows, keyed_lookup, placed_rows
from cinderpost.operators.network import HISTORY, OUTPUT, NetworkModel
from cinderpost.operators.ranking import dense_index
from cinderpost.session import discard, ship_package, stage

# Step lengths that a line search tries, in terms of the proposed step.
STEPS = tuple(4.0**k for k in range(5, -7, -1))
# A run has settled when no step lowers its loss by more than this share.
SETTLED = 1e-7


@dataclass(frozen=True)
class Learner:
    """A run: ``weighting`` is the place of its values in a row, ``hidden=0`` is logistic."""

    run_id: str
    weighting: int = 0
    hidden: int = 0

    @property
    def width(self) -> int:
        return max(self.hidden, 1)


@dataclass(frozen=True)
class Search:
    """How runs are trained: ``rounds`` at most, each one step over all posts.

    Without a ``rate`` steps are quasi-Newton with ``pairs`` remembered steps and a line search;
    with one they go down the gradient by it. Weights start uniformly within ``start`` of zero.
    Of a run the round with the best validation accuracy is kept; it ends when its mean squared
    error is ``enough``, when it has settled, or when a round falls below the ``window - 1``
    before it.
    """

    rounds: int = 40
    pairs: int = 3
    rate: float | None = None
    start: float = 0.05
    seed: int = 7
    window: int = 12
    enough: float = 1e-4


@dataclass
class Units:
    """Places of the runs' units in arrays that hold them all."""

    learners: Sequence[Learner]
    slices: list[slice] = field(init=False)
    values: list[int] = field(init=False)

    def __post_init__(self):
        ends = np.cumsum([learner.width for learner in self.learners]).tolist()
        self.slices = [slice(b - x.width, b) for b, x in zip(ends, self.learners)]
        self.values = [x.weighting for x in self.learners for _ in range(x.width)]

    def __len__(self) -> int:
        return len(self.values)

    def sums(self) -> list[Column]:
        """Of a post's rows, joined to weights ``w``: the weighted sum of every unit."""
        weight = lambda u: F.coalesce(F.get("w", F.lit(u)), F.lit(0.0))
        return [F.sum(F.get("v", F.lit(r)) * weight(u)).alias(f"_z{u}") for u, r in enumerate(self.values)]

    def gathered(self) -> Column:
        return F.array(*[F.col(f"_z{u}") for u in range(len(self))])

    def slopes(self, z: np.ndarray, y: np.ndarray, trains: np.ndarray, outs: list[np.ndarray]):
        """Per run the slope of a post's score, its inner activations, and the slopes of its units."""
        for learner, own, out in zip(self.learners, self.slices, outs):
            inner, p = _output(learner, z[:, own], out)
            slope = np.where(trains, 2 * (p - y) * p * (1 - p), 0.0)
            yield slope, inner, slope[:, None] * out[:-1] * inner * (1 - inner) if learner.hidden else slope[:, None]

    def spread(self, by_run: Sequence[float]) -> np.ndarray:
        """One number per run as one per unit."""
        return np.repeat(np.asarray(by_run, float), [x.width for x in self.learners])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _output(learner: Learner, z: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Activations of a run's units, and its score."""
    inner = _sigmoid(z)
    return inner, _sigmoid(inner @ out[:-1] + out[-1]) if learner.hidden else inner[:, 0]


def _stacked(column: pd.Series, width: int) -> np.ndarray:
    """Arrays of doubles, or their bytes, as rows of a matrix."""
    if not len(column):
        return np.zeros((0, width))
    if isinstance(column.iloc[0], (bytes, bytearray)):
        return np.frombuffer(b"".join(column), float).reshape(-1, width)
    return np.stack(column.to_numpy()).reshape(-1, width)


def _packed(matrix: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(matrix, float).reshape(len(matrix), -1)]


def _proposed(vectors: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    """The proposed step made of the vectors of posts."""
    return np.einsum("nvu,vu->nu", vectors, coefficients)


def _vectors(column: pd.Series, size: int) -> np.ndarray:
    """The vectors of a batch of posts."""
    return _stacked(column, 1).reshape(len(column), -1, size)


def _sums(batch: pd.DataFrame, size: int, fresh: ByPost | None) -> np.ndarray:
    """What each vector adds to a post's sums; ``fresh`` are those of the newest gradient."""
    sums = _vectors(batch["sums"], size)
    return sums if fresh is None else _completed(sums, fresh.of(batch["id"].to_numpy()))


def _completed(sums: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The sums of the newest gradient, and of the difference that it ends, filled in."""
    sums, side = sums.copy(), sums.shape[1]
    sums[:, -1] = new
    if side > 1:
        sums[:, side - 2] += new
    return sums


# What is carried along by post: bytes of doubles, which are written and read at once. ``w`` and
# ``best`` are the slopes that the weights were made from, ``slopes`` those of every remembered
# vector, ``sums`` what each vector adds to the post's sums.
STATE = "target int, trains boolean, z binary, w binary, best binary, slopes binary, sums binary"


def _added(df: DataFrame, part: Callable[[pd.DataFrame], np.ndarray], size: int) -> np.ndarray:
    """Sum over the batches of a table of the few numbers that ``part`` makes of each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                total += part(batch)
        yield pd.DataFrame({"x": _packed(total[None])})

    out = np.zeros(size)
    for r in df.mapInPandas(run, "x binary").collect():  # one row per task
        out += np.frombuffer(r["x"])
    return out


@dataclass
class ManyModels:
    """Weights of all runs: table ``feature, w``, and their output layers."""

    units: Units
    weights: DataFrame
    outputs: list[np.ndarray]
    history: DataFrame | None = None

    def score(self, rows: DataFrame) -> DataFrame:
        """``run_id, id, target, p, pred`` of written rows ``id, feature, v``, one join for all runs.

        ``target`` is carried along if there is one. Every post with a row has a score; features
        without weights count as weight 0.
        """
        units, outputs = self.units, self.outputs
        kept = carried(rows, "target")
        found = keyed_lookup(rows, self.weights.select("feature", "w"), "feature")
        sums = found.groupBy("id").agg(*[F.max(c).alias(c) for c in kept], *units.sums())
        kinds = dict(rows.dtypes)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                z = _stacked(batch["z"], len(units))
                for learner, own, out in zip(units.learners, units.slices, outputs):
                    p = _output(learner, z[:, own], out)[1]
                    yield pd.DataFrame({"run_id": learner.run_id, **{c: batch[c] for c in ("id", *kept)}, "p": p})

        schema = ", ".join(f"{c} {kinds[c]}" for c in ("id", *kept))
        scored = sums.select("id", *kept, units.gathered().alias("z")).mapInPandas(run, f"run_id string, {schema}, p double")
        return scored.withColumn("pred", S.threshold(F.col("p")))

    def model(self, run_id: str) -> NetworkModel:
        """One run alone."""
        at = [x.run_id for x in self.units.learners].index(run_id)
        own, learner = self.units.slices[at], self.units.learners[at]
        weights = self.weights.select("feature", F.slice("w", own.start + 1, learner.width).alias("w"))
        if learner.hidden:
            spark = weights.sparkSession
            output = [(OUTPUT, [float(x) for x in self.outputs[at]])]
            weights = weights.unionByName(spark.createDataFrame(output, "feature string, w array<double>"))
        history = None if self.history is None else self.history.filter(F.col("run_id") == run_id)
        return NetworkModel(weights, learner.hidden, history)


def random_start(units: Units, search: Search) -> tuple[Column, list[np.ndarray]]:
    """Repeatable starting weights by ``feature``, and output layers."""

    def drawn(u):
        part = F.pmod(F.xxhash64("feature", u, F.lit(search.seed)), F.lit(1 << 30)) / float(1 << 29)
        return (part - 1.0) * search.start

    draws = np.random.default_rng(search.seed)
    outputs = [draws.uniform(-1, 1, x.hidden + 1) * bool(x.hidden) for x in units.learners]
    return F.transform(F.sequence(F.lit(1), F.lit(len(units))), drawn), outputs


def _coefficients(gram: np.ndarray, pairs: list[int], count: int) -> np.ndarray:
    """The quasi-Newton step as numbers of steps, gradient differences and the gradient.

    ``gram`` holds their inner products: ``count`` steps, as many differences, the gradient.
    ``pairs`` are the usable ones, oldest first. The two loops of the limited-memory method need
    nothing but these products.
    """
    q = np.zeros(2 * count + 1)
    q[-1] = 1.0
    alpha = {}
    for i in reversed(pairs):
        alpha[i] = gram[i] @ q / gram[i, count + i]
        q[count + i] -= alpha[i]
    if pairs:
        newest = pairs[-1]
        q *= gram[newest, count + newest] / gram[count + newest, count + newest]
    for i in pairs:
        q[i] += alpha[i] - gram[count + i] @ q / gram[i, count + i]
    return -q


class _Training:
    """Tables and numbers of a training in progress.

    Vectors by feature are told by their posts: ``slopes`` s stand for the sum of the training
    rows times s, ``sums`` are the rows of a post times that vector. How rows are summed is left to
    the two kinds below.
    """

    back = "array<double>"

    def __init__(self, labels: DataFrame, units: Units, search: Search):
        self.labels, self.units, self.search = labels, units, search
        self.n = max(1, labels.filter("trains").count())
        self.fresh: ByPost | None = None  # sums that the state doesn't have yet
        self.kept = 0  # pairs that the state holds
        self.pairs: list[list[int]] = [[] for _ in units.learners]
        self.out_pairs: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in units.learners]

    def schema(self, posts: DataFrame) -> str:
        return f"id {dict(posts.dtypes)['id']}, {STATE}"

    def begun(self, posts: DataFrame, z: Callable[[pd.DataFrame], np.ndarray]) -> DataFrame:
        """Written posts with the sums ``z`` under the starting weights, and no vectors yet."""
        size = len(self.units)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    none = _packed(np.zeros((len(batch), size)))
                    columns = {c: none for c in ("w", "best", "slopes", "sums")}
                    yield pd.DataFrame({**{c: batch[c] for c in ("id", "target", "trains")}, "z": _packed(z(batch)), **columns})

        return stage(posts.mapInPandas(run, self.schema(posts)), "posts")

    def tried(self, posts: DataFrame, coefficients: np.ndarray, outs, out_moves, steps: np.ndarray) -> np.ndarray:
        """Per run and step length: loss, right training posts, right validation posts."""
        units, size, fresh = self.units, len(self.units), self.fresh

        def part(batch: pd.DataFrame) -> np.ndarray:
            z, move = _stacked(batch["z"], size), _proposed(_sums(batch, size, fresh), coefficients)
            y, trains = batch["target"].to_numpy(float), batch["trains"].to_numpy(bool)
            found = np.zeros((len(units.learners), steps.shape[1], 3))
            for k, (learner, own) in enumerate(zip(units.learners, units.slices)):
                for j, t in enumerate(steps[k]):
                    p = _output(learner, z[:, own] + t * move[:, own], outs[k] + t * out_moves[k])[1]
                    right = (p > 0.5) == (y == 1)
                    found[k, j] = ((p - y)[trains] ** 2).sum(), right[trains].sum(), right[~trains].sum()
            return found.ravel()

        columns = posts.select("id", "target", "trains", "z", "sums")
        return _added(columns, part, len(units.learners) * steps.shape[1] * 3).reshape(len(units.learners), -1, 3)

    def moved(
        self, posts: DataFrame, outs: list[np.ndarray], coefficients: np.ndarray, steps: list[float], better: list[bool], keep: int
    ) -> tuple[DataFrame, list[np.ndarray]]:
        """Posts after the steps, the sums of the new gradient left out; slopes of the output layers.

        The newest ``keep`` pairs stay.
        """
        units, size, k, fresh = self.units, len(self.units), self.kept, self.fresh
        by_unit, taken, n = units.spread(steps), units.spread(better).astype(bool), self.n
        slopes_back = list if self.back == "array<double>" else _packed

        def after(vectors: np.ndarray, step: np.ndarray, new: np.ndarray) -> np.ndarray:
            s = np.concatenate([vectors[:, :k], step[:, None]], axis=1)
            y = np.concatenate([vectors[:, k : 2 * k], (new - vectors[:, -1])[:, None]], axis=1)
            return np.concatenate([s[:, k + 1 - keep :], y[:, k + 1 - keep :], new[:, None]], axis=1)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                z, w, best = (_stacked(batch[c], size) for c in ("z", "w", "best"))
                known, sums = _vectors(batch["slopes"], size), _sums(batch, size, fresh)
                step, move = _proposed(known, coefficients) * by_unit, _proposed(sums, coefficients) * by_unit
                z, w = z + move, w + step
                y, trains = batch["target"].to_numpy(float), batch["trains"].to_numpy(bool)
                back = np.hstack([b for *_, b in units.slopes(z, y, trains, outs)]) / n
                columns = {
                    "z": z, "w": w, "best": np.where(taken, w, best),
                    "slopes": after(known, step, back), "sums": after(sums, move, np.zeros_like(back)),
                }
                kept = {c: batch[c] for c in ("id", "target", "trains")}
                yield pd.DataFrame({**kept, **{c: _packed(x) for c, x in columns.items()}, "back": slopes_back(back)})

        state = posts.select(*[c for c in posts.columns if c != "back"])
        found = stage(state.mapInPandas(run, f"{self.schema(posts)}, back {self.back}"), "moved")
        self.refresh(None)
        if not any(x.hidden for x in units.learners):
            return found, [np.zeros(1) for _ in units.learners]

        def part(batch: pd.DataFrame) -> np.ndarray:
            y, trains = batch["target"].to_numpy(float), batch["trains"].to_numpy(bool)
            own = units.slopes(_stacked(batch["z"], size), y, trains, outs)
            return np.concatenate([np.append(inner.T @ slope, slope.sum()) for slope, inner, _ in own])

        columns = found.select("target", "trains", "z")
        sums = _added(columns, part, sum(x.width + 1 for x in units.learners)) / self.n
        ends = np.cumsum([x.width + 1 for x in units.learners])[:-1]
        return found, [g * bool(x.hidden) if x.hidden else np.zeros(1) for g, x in zip(np.split(sums, ends), units.learners)]

    def products(self, posts: DataFrame, outs_g: list[np.ndarray]) -> list[np.ndarray]:
        """Per run the inner products of its pairs and its gradient."""
        units, size, fresh = self.units, len(self.units), self.fresh
        side = 2 * self.kept + 1

        def part(batch: pd.DataFrame) -> np.ndarray:
            slopes, sums = _vectors(batch["slopes"], size), _sums(batch, size, fresh)
            return np.concatenate([np.einsum("nau,nbu->ab", slopes[:, :, own], sums[:, :, own]).ravel() for own in units.slices])

        found = []
        grams = _added(posts.select("id", "slopes", "sums"), part, side * side * len(units.learners)).reshape(-1, side, side)
        for gram, pairs, g in zip(grams, self.out_pairs, outs_g):
            own = np.stack([*[s for s, _ in pairs], *[y for _, y in pairs], g])
            found.append((gram + gram.T) / 2 + own @ own.T)
        return found

    def refresh(self, fresh: ByPost | None) -> None:
        if self.fresh is not None:
            self.fresh.destroy()
        self.fresh = fresh


class _OnBlocks(_Training):
    """Rows packed by feature. Posts are told by their places, which are ``id`` in the state."""

    back = "binary"

    def __init__(self, labels: DataFrame, blocks: Blocks, units: Units, search: Search):
        super().__init__(labels, units, search)
        self.blocks, self.context = blocks, labels.sparkSession.sparkContext

    def first_posts(self, start: Column, validation: int) -> DataFrame:
        """Posts with their sums under the starting weights; what no training post has is in no block."""
        first = ByPost.sent(self.context, (self.blocks.sums(None, g) for g in self.blocks.groups), len(self.units))
        posts = self.begun(self.labels, lambda batch: first.of(batch["id"].to_numpy()))
        first.destroy()
        return posts

    def sent(self, posts: DataFrame, column: str, group: slice) -> Broadcast:
        return self.context.broadcast(gathered(posts, column, group, len(self.units), self.blocks.n))

    def projected(self, posts: DataFrame) -> DataFrame:
        """Posts of ``moved``; the sums of the new gradient are sent to the tasks that use them."""

        def found() -> Iterator[np.ndarray]:
            for group in self.blocks.groups:
                back = self.sent(posts, "back", group)
                yield self.blocks.sums(back, group)
                back.destroy()

        self.refresh(ByPost.sent(self.context, found(), len(self.units)))
        return posts

    def best(self, posts: DataFrame, start: Column) -> DataFrame:
        """``feature, w`` of the rounds that are kept."""
        groups, parts = self.blocks.groups, []
        sent = [self.sent(posts, "best", group) for group in groups]
        for k, (back, group) in enumerate(zip(sent, groups)):
            parts.append(self.blocks.weights(back, group).withColumn("group", F.lit(k)))
        if len(parts) == 1:
            weights = parts[0].select("feature", "w")
        else:
            found = parts[0]
            for part in parts[1:]:
                found = found.unionByName(part)
            pieces = F.sort_array(F.collect_list(F.struct("group", "w")))
            weights = found.groupBy("feature").agg(F.flatten(F.transform(pieces, lambda x: x["w"])).alias("w"))
        with small_batches(weights.sparkSession):
            weights = stage(weights, "weights")
        for back in sent:
            back.destroy()
        return weights


class _OnRows(_Training):
    """Rows by post, and those of rare features by feature, joined in every round."""

    def __init__(self, placed: PlacedRows, units: Units, search: Search, limit: int):
        labels = placed.by_post.filter(F.col("feature") == BIAS).select("id", "target", "trains")
        super().__init__(labels, units, search)
        self.placed = placed
        self.near = self.n * (8 * len(units) + 128) <= limit  # slopes of all posts may be broadcast

    def first_posts(self, start: Column, validation: int) -> DataFrame:
        """Posts with their sums under the starting weights."""
        rows, size = self.placed.by_post, len(self.units)
        known = rows.filter("trains")
        if validation:
            # What no training post has keeps weight 0.
            names = stage(known.select("feature").distinct(), "train-features")
            known = known.unionByName(rows.filter("NOT trains").join(names, "feature", "left_semi"))
        sums = known.withColumn("w", start).groupBy("id").agg(*self.units.sums()).select("id", self.units.gathered().alias("z"))
        zero = F.array_repeat(F.lit(0.0), size)
        begun = self.labels.join(sums, "id", "left").withColumn("z", F.coalesce("z", zero))
        return self.begun(begun, lambda batch: _stacked(batch["z"], size))

    def to_features(self, back: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """``feature, w``: sums of the training rows times ``back`` of their post.

        All features, or those of the hot ones and of the rest. If the slopes can be broadcast,
        rows of rare features meet them where they lie by feature, and nothing is shuffled.
        """
        placed = self.placed
        total = F.array(*[F.sum(F.get("v", F.lit(r)) * F.get("back", F.lit(u))) for u, r in enumerate(self.units.values)])

        def summed(rows: DataFrame) -> DataFrame:
            trained = rows.filter("trains").select("id", "feature", "v")
            return trained.join(F.broadcast(back) if self.near else back, "id").groupBy("feature").agg(total.alias("w"))

        if placed.rare is None:
            return summed(placed.by_post), None
        hot = summed(placed.by_post.join(F.broadcast(placed.hot), "feature", "left_semi"))
        rest = placed.rare if self.near else placed.by_post.join(F.broadcast(placed.hot), "feature", "left_anti")
        return hot, summed(rest)

    def projected(self, posts: DataFrame) -> DataFrame:
        """Posts of ``moved`` with the sums of the new gradient."""
        size, placed, units = len(self.units), self.placed, self.units
        hot, rest = self.to_features(posts.filter("trains").select("id", "back"))
        near = placed.by_post.join(F.broadcast(hot), "feature").groupBy("id").agg(*units.sums())
        if rest is not None:
            far = placed.rare.join(rest, "feature").groupBy("id").agg(*units.sums())
            names = [c for c in near.columns if c != "id"]
            near = near.unionByName(far).groupBy("id").agg(*[F.sum(c).alias(c) for c in names])
        found = near.select("id", units.gathered().alias("back"))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                sums = _completed(_vectors(batch["sums"], size), _stacked(batch["back"], size))
                yield pd.DataFrame({**{c: batch[c] for c in batch.columns if c != "back"}, "sums": _packed(sums)})

        zero = F.array_repeat(F.lit(0.0), size)
        joined = posts.drop("back").join(found, "id", "left").withColumn("back", F.coalesce("back", zero))
        found = stage(joined.mapInPandas(run, self.schema(posts)), "posts")
        discard(posts)
        return found

    def best(self, posts: DataFrame, start: Column) -> DataFrame:
        """``feature, w`` of the rounds that are kept."""
        size = len(self.units)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.DataFrame({"id": batch["id"], "back": list(_stacked(batch["best"], size))})

        kept = posts.filter("trains").select("id", "best")
        back = stage(kept.mapInPandas(run, f"id {dict(posts.dtypes)['id']}, back array<double>"), "best")
        hot, rest = self.to_features(back)
        moved = hot if rest is None else hot.unionByName(rest)
        weights = moved.select("feature", F.zip_with("w", start, lambda a, b: a + b).alias("w"))
        weights = stage(weights, "weights")
        discard(back)
        return weights


@contextmanager
def _begun_training(rows: DataFrame, units: Units, search: Search, start: Column, limit: int) -> Iterator[_Training]:
    """The training on blocks, or on rows where one unit of all posts is beyond the limit."""
    labels = rows.filter(F.col("feature") == BIAS).select("id", "target", "trains")
    n = labels.count()
    if 8 * n > limit:
        with placed_rows(rows, "id", "feature", "target", BIAS, len(units), limit) as placed:
            yield _OnRows(placed, units, search, limit)
        return
    numbered = stage(dense_index(labels, "id", "place"), "places")
    places = numbered.select("id", F.col("place").cast("int").alias("place"))
    near = F.broadcast(places) if 128 * n <= limit else places
    blocks = Blocks(pack(rows.join(near, "id"), start, max(units.values) + 1, len(units)), n, units.values, limit)
    # Tasks of posts: one a core if that is worth it, and none of more than some 64 MB.
    cores, numbers = rows.sparkSession.sparkContext.defaultParallelism, n * len(units)
    tasks = max(1, min(cores, numbers // 30_000), numbers * 8 * (4 * search.pairs + 5) >> 26)
    by_place = numbered.select(F.col("place").cast("int").alias("id"), "target", "trains").repartitionByRange(tasks, "id")
    posts = stage(by_place, "labels")
    work = _OnBlocks(posts, blocks, units, search)
    try:
        yield work
    finally:
        work.refresh(None)
        blocks.discard()
        discard(numbered, posts)


def fit_many(
    rows: DataFrame,
    learners: Sequence[Learner],
    search: Search,
    start: tuple[Column, list[np.ndarray]] | None = None,
    broadcast_bytes: int | None = None,
) -> ManyModels:
    """Train runs on written rows ``id, target, trains, feature, v`` that include the bias rows.

    ``v`` holds a feature's value under every weighting. Posts that don't train are validation
    posts: the round that is right for most of them is kept, the last one if there are none.
    Runs go on side by side, each with its own step; one that has settled stands still.
    """
    ship_package(rows.sparkSession)
    units = Units(learners)
    first, outs = start or random_start(units, search)
    outs = [np.asarray(o, float) if x.hidden else np.zeros(1) for o, x in zip(outs, learners)]
    checked = rows.withColumn("target", S.checked_label("target"))
    runs = range(len(learners))
    limit = lookup.BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    with _begun_training(checked, units, search, first, limit) as work:
        validation = work.labels.filter("NOT trains").count()
        begun = work.first_posts(first, validation)
        still = np.zeros((1, len(units)))
        loss = work.tried(begun, still, outs, [np.zeros_like(o) for o in outs], np.zeros((len(learners), 1)))[:, 0, 0]
        after, outs_g = work.moved(begun, outs, still, [0.0] * len(learners), [False] * len(learners), 0)
        posts = work.projected(after)
        discard(begun)
        best_outs, curves, going = [o.copy() for o in outs], [[] for _ in runs], [True] * len(learners)
        history: list[tuple] = []
        for round_no in range(1, search.rounds + 1):
            k = work.kept
            if search.rate is None:
                grams = work.products(posts, outs_g)
                usable = [[i for i in work.pairs[r] if grams[r][i, k + i] > 1e-12 * grams[r][k + i, k + i]] for r in runs]
                chosen = np.stack([_coefficients(grams[r], usable[r], k) for r in runs])
            else:
                chosen = np.zeros((len(learners), 2 * k + 1))
                chosen[:, -1] = -1.0
            out_moves = [
                np.sum([c * v for c, v in zip(chosen[r], [*[s for s, _ in work.out_pairs[r]], *[y for _, y in work.out_pairs[r]], outs_g[r]])], axis=0)
                for r in runs
            ]
            coefficients = np.stack([units.spread(chosen[:, b]) for b in range(2 * k + 1)])
            sizes = np.array([STEPS if search.rate is None else (search.rate,)] * len(learners))
            facts = work.tried(posts, coefficients, outs, out_moves, sizes)
            steps, better = [], []
            for r in runs:
                at = int(facts[r, :, 0].argmin())
                lower = loss[r] - facts[r, at, 0] > SETTLED * max(loss[r], 1e-300)
                if search.rate is None and going[r] and not lower:
                    # Remembered pairs may mislead; without them the step is the gradient's.
                    going[r], work.pairs[r] = bool(work.pairs[r]), []
                moves = search.rate is not None or (going[r] and lower)
                steps.append(float(sizes[r, at]) if moves else 0.0)
                if not moves:
                    better.append(False)
                    continue
                loss[r] = facts[r, at, 0]
                accuracy = 100.0 * float(facts[r, at, 2]) / validation if validation else float(round_no)
                shown = 100.0 * float(facts[r, at, 1]) / work.n
                better.append(H.is_kept(curves[r], accuracy))
                going[r] = not H.stops(curves[r], accuracy, search.window) and loss[r] > search.enough * work.n
                curves[r].append(accuracy)
                history.append((learners[r].run_id, round_no, float(loss[r]) / work.n, shown, accuracy))
            outs = [o + t * m for o, t, m in zip(outs, steps, out_moves)]
            best_outs = [o.copy() if b else old for o, b, old in zip(outs, better, best_outs)]
            keep = min(search.pairs, k + 1) if search.rate is None else 0
            after, new_g = work.moved(posts, outs, coefficients, steps, better, keep)
            discard(posts)
            posts = after
            if round_no == search.rounds or (search.rate is None and not any(going)):
                break
            posts = work.projected(after)
            for r in runs:
                pair = (steps[r] * out_moves[r], new_g[r] - outs_g[r])
                work.out_pairs[r] = [*work.out_pairs[r], pair][k + 1 - keep :]
                dropped = k + 1 - keep
                known = [*work.pairs[r], k] if steps[r] else work.pairs[r]
                work.pairs[r] = [i - dropped for i in known if i >= dropped]
            work.kept, outs_g = keep, new_g
        weights = work.best(posts, first)
        discard(posts)
    curve = rows.sparkSession.createDataFrame(history, HISTORY)
    return ManyModels(units, weights, best_outs, curve)
