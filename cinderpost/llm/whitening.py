"""Embedding whitening: spectra built by rank-one updates, combined, refined over all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderpost.session import discard, ship_package, stage

COMPONENTS = 32
# States that one task combines; what it holds is this many matrices of dimension x dimension.
FAN_IN = 8
# The refinement has settled once whitened rows are this close to uncorrelated.
SETTLED = 1e-9
MOST_REFINEMENTS = 6
# Eigenvalues below this share of the largest, times the dimension, are no variance.
NO_VARIANCE = 1e-14

_EPS = np.finfo(float).eps


def _secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z2 / (d - x)) for rising d and positive z2, one above each d.

    Returned as (pole, offset): root k is d[pole[k]] + offset[k], with the nearer pole, so that
    its distance to the poles keeps full relative precision. Each step fits a rational function
    through the values and slopes on both sides; steps that leave the bracket halve it.
    """
    k = len(d)
    upper = np.append(d[1:], d[-1] + z2.sum())
    gap = upper - d
    middle = 1 + (z2 / (d - (d + gap / 2)[:, None])).sum(axis=1)
    pole = np.arange(k) + ((middle < 0) & (np.arange(k) < k - 1))
    origin = d[pole]
    left = pole == np.arange(k)
    # The bracket of the offset from the nearer pole.
    lo = np.where(left, np.where(middle < 0, gap / 2, 0.0), -gap / 2)
    hi = np.where(left, np.where(middle < 0, gap, gap / 2), 0.0)
    shifted = d[None, :] - origin[:, None]
    lower = np.tri(k)
    own, nxt = shifted[np.arange(k), np.arange(k)], shifted[np.arange(k), np.minimum(np.arange(k) + 1, k - 1)]
    nxt = np.where(np.arange(k) == k - 1, gap[-1] - (origin[-1] - d[-1]), nxt)
    x = (lo + hi) / 2
    with np.errstate(all="ignore"):
        for _ in range(80):
            far = shifted - x[:, None]
            terms = z2 / far
            slopes = terms / far
            f = 1 + terms.sum(axis=1)
            all_slopes, below = slopes.sum(axis=1), np.einsum("ij,ij->i", slopes, lower)
            size = 1 + np.abs(terms).sum(axis=1)
            # f rises from pole to pole.
            lo, hi = np.where(f < 0, x, lo), np.where(f < 0, hi, x)
            done = (np.abs(f) <= 4 * _EPS * size) | (hi - lo <= 2 * _EPS * np.maximum(np.abs(lo), np.abs(hi)))
            if done.all():
                break
            a0, b0 = own - x, nxt - x
            a = (a0 + b0) * f - a0 * b0 * all_slopes
            b = a0 * b0 * f
            c = f - a0 * below - b0 * (all_slopes - below)
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            after = x + step
            inside = np.isfinite(after) & (after > lo) & (after < hi)
            x = np.where(done, x, np.where(inside, after, (lo + hi) / 2))
    return pole, x


def rank_one(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of V diag(values) V' + rho * u u' for z = V'u and rho >= 0.

    ``values`` rise. Deflation: parts of ``z`` that don't matter leave their pairs as they are,
    and within equal values one reflection turns ``z`` into a single part. The others are roots
    of the secular equation; their vectors come from the ``z`` that these roots belong to, which
    keeps the vectors orthogonal.
    """
    length = float(z @ z)
    if rho <= 0 or length == 0:
        return values, vectors
    z, vectors = z.copy(), vectors.copy()
    scale = max(abs(values[0]), abs(values[-1]), rho * length)
    same = 8 * _EPS * scale
    starts = np.flatnonzero(np.append(True, np.diff(values) > same))
    ends = np.append(starts[1:], len(values))
    for at, to in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
        size = np.linalg.norm(z[at:to])
        if size > 0:
            mirror = z[at:to].copy()
            mirror[-1] += size if mirror[-1] >= 0 else -size
            part = vectors[:, at:to]
            vectors[:, at:to] = part - np.outer(part @ mirror, mirror) * (2 / (mirror @ mirror))
            last = -size if z[to - 1] >= 0 else size
            z[at:to] = 0
            z[to - 1] = last
    live = np.flatnonzero(rho * np.abs(z) * np.sqrt(length) > same)
    if not len(live):
        return values, vectors
    d, zl = values[live], z[live]
    pole, offset = _secular_roots(d, rho * zl * zl)
    # Root j minus value i, without cancellation.
    away = (d[pole] - d[:, None]) + offset
    apart = d[None, :] - d[:, None]
    np.fill_diagonal(apart, 1.0)
    exact = np.sqrt(np.abs(np.prod(away / apart, axis=1) / rho)) * np.sign(zl)
    turn = exact[:, None] / -away
    turn /= np.linalg.norm(turn, axis=0)
    out = values.copy()
    out[live] = d[pole] + offset
    vectors[:, live] = vectors[:, live] @ turn
    order = np.argsort(out, kind="stable")
    return out[order], vectors[:, order]


@dataclass
class Spectrum:
    """Rows seen, their mean, and the spectrum of their centred scatter (values rise)."""

    n: float
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(dim: int) -> Spectrum:
        return Spectrum(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, x: np.ndarray) -> None:
        """One more row: the scatter grows by one centred product."""
        away = x - self.mean
        self.n += 1
        self.mean = self.mean + away / self.n
        self.values, self.vectors = rank_one(self.values, self.vectors, self.vectors.T @ away, (self.n - 1) / self.n)

    def combine(self, other: Spectrum) -> None:
        """The rows of another spectrum: its pairs one after the other, then the means' difference."""
        for value, vector in zip(other.values, other.vectors.T):
            self.values, self.vectors = rank_one(self.values, self.vectors, self.vectors.T @ vector, float(value))
        away, n = other.mean - self.mean, self.n + other.n
        self.values, self.vectors = rank_one(self.values, self.vectors, self.vectors.T @ away, self.n * other.n / n)
        self.mean = self.mean + away * (other.n / n)
        self.n = n

    def pack(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.values, self.vectors.ravel()]).tobytes()

    @staticmethod
    def unpack(data: bytes, dim: int) -> Spectrum:
        a = np.frombuffer(data, float)
        return Spectrum(a[0], a[1 : 1 + dim], a[1 + dim : 1 + 2 * dim], a[1 + 2 * dim :].reshape(dim, dim))


def _matrix(batch: pd.DataFrame, dim: int) -> np.ndarray:
    return np.stack(batch["v"].to_numpy()).astype(float).reshape(-1, dim)


def _spectra(dim: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Spectrum.empty(dim)
        for batch in batches:
            for x in _matrix(batch, dim) if len(batch) else ():
                own.add(x)
        if own.n:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "state": [own.pack()]})

    return run


def _moments(dim: int, mean: np.ndarray, basis: np.ndarray):
    """Sum and products of the rows of a partition, in a basis, about a mean."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total, products = 0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            if len(batch):
                y = (_matrix(batch, dim) - mean) @ basis
                n, total, products = n + len(y), total + y.sum(axis=0), products + y.T @ y
        if n:
            state = np.concatenate([[float(n)], total, products.ravel()]).tobytes()
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "state": [state]})

    return run


def _added(states: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(s, float) for s in states], axis=0).tobytes()


def _joined_spectra(dim: int):
    def join(states: list[bytes]) -> bytes:
        first, *rest = (Spectrum.unpack(s, dim) for s in states)
        for other in rest:
            first.combine(other)
        return first.pack()

    return join


def _combined(rows: DataFrame, run: Callable, join: Callable[[list[bytes]], bytes]) -> bytes:
    """The state of all rows: one a partition, then FAN_IN become one until one is left.

    A state's size depends on the dimension alone; the driver gets the last one.
    """
    schema = "part long, state binary"

    def group(key: tuple, states: pd.DataFrame) -> pd.DataFrame:
        ordered = states.sort_values("part")["state"].tolist()
        return pd.DataFrame({"part": [key[0]], "state": [join(ordered)]})

    states = stage(rows.mapInPandas(run, schema), "states")
    while states.limit(2).count() > 1:
        # groupBy is by key, so states that meet lie beside each other among the partitions.
        after = stage(
            states.select(F.floor(F.col("part") / FAN_IN).alias("part"), "state")
            .groupBy("part")
            .applyInPandas(group, schema),
            "states",
        )
        discard(states)
        states = after
    last = states.first()["state"]
    discard(states)
    return bytes(last)


@dataclass
class Whitening:
    """Mean, eigenvalues (falling), unit eigenvectors (columns) of all rows' covariance, divisor n.

    ``error`` is the largest entry by which the covariance of the whitened rows, measured over all
    rows, differs from the identity. Components without variance take no part in it.
    """

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    most: int
    error: float

    def apply(self, vec: str) -> Column:
        """Column of the first ``most`` whitened entries; null where a component has no variance."""
        mean, most = self.mean, self.most
        vectors = self.vectors[:, :most]
        with np.errstate(divide="ignore"):
            scale = np.where(self.varying()[:most], 1 / np.sqrt(np.maximum(self.values[:most], 0)), np.nan)

        @F.pandas_udf("array<double>")
        def whiten(vecs: pd.Series) -> pd.Series:
            y = (np.stack(vecs.to_numpy()).astype(float) - mean) @ vectors * scale
            return pd.Series(list(y)) if len(y) else pd.Series([], dtype=object)

        return F.transform(whiten(vec), lambda x: F.when(~F.isnan(x), x))

    def varying(self) -> np.ndarray:
        return self.values > max(self.values[0], 0.0) * len(self.values) * NO_VARIANCE

    def explained(self) -> list[float]:
        """Share of the variance of each of the first components; 0 if there is no variance."""
        values = np.maximum(self.values, 0)
        return (values / (values.sum() or 1.0))[: self.most].tolist()


def fit(vectors: DataFrame, vec: str, dim: int, most: int = COMPONENTS) -> Whitening | None:
    """Whitening of all rows of a written table; None for an empty one.

    ``vec`` holds ``dim`` finite doubles in every row.

    1. Every partition builds its spectrum row by row: the scatter about the running mean grows by
       one centred product, whose spectrum follows from the secular equation, with deflation.
    2. Spectra are combined, eight in a task, by as many rank-one updates as there are dimensions.
    3. The basis is refined over all rows: products of centred rows in the basis are summed and
       their small eigenproblem turns the basis (Rayleigh-Ritz); a last pass measures the result.

    All rows take part in each step. A task holds matrices of ``dim`` x ``dim``, never its rows.
    """
    ship_package(vectors.sparkSession)
    rows = vectors.select(F.col(vec).cast("array<double>").alias("v"))
    if not rows.limit(1).count():
        return None
    most = min(most, dim)
    whole = Spectrum.unpack(_combined(rows, _spectra(dim), _joined_spectra(dim)), dim)
    mean, basis, last = whole.mean, np.linalg.qr(whole.vectors[:, ::-1])[0], None
    for _ in range(MOST_REFINEMENTS):
        sums = np.frombuffer(_combined(rows, _moments(dim, mean, basis), _added), float)
        n, away = sums[0], sums[1 : 1 + dim] / sums[0]
        covariance = sums[1 + dim :].reshape(dim, dim) / n - np.outer(away, away)
        if last is not None:
            result = Whitening(int(n), mean, np.diag(covariance).copy(), basis, most, 0.0)
            live = np.flatnonzero(result.varying()[:most])
            scale = np.sqrt(result.values[live])
            white = covariance[np.ix_(live, live)] / np.outer(scale, scale)
            # What is left of the mean, and entries beyond the first components, count as well.
            rest = np.abs(covariance - np.diag(result.values))[:most].max(initial=0.0) / (result.values[0] or 1.0)
            result.error = float(np.abs(white - np.eye(len(live))).max(initial=0.0))
            if max(result.error, rest) <= SETTLED:
                return result
        values, turn = np.linalg.eigh((covariance + covariance.T) / 2)
        mean = mean + basis @ away
        basis = np.linalg.qr(basis @ turn[:, ::-1])[0]
        last = values
    raise RuntimeError(f"components are not settled after {MOST_REFINEMENTS} refinements")


def whitened_table(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: key, component, n, deviation, whitened, explained, identity_error.

    Null vectors and vectors with null or non-finite entries are dropped. Entries c become
    fixed-point numbers floor(64 * c) + 1000000; a number that a long can't hold is an error.
    Vectors shorter than the longest, empty ones too, are filled up with entries 0. Repeated rows,
    ties and null keys are rows like others; of equal eigenvalues any basis of their space may
    come, the same for all rows. Components without variance (as many as the dimension, if all
    vectors are equal) have null ``whitened``. Without usable vectors there are no rows. Other
    columns are ignored, whatever their names.
    """
    entry = F.col(vec)
    good = entry.isNotNull() & F.forall(
        entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    )
    fixed = F.transform(entry, lambda c: F.floor(c.cast("double") * 64).cast("long"))
    ragged = stage(vectors.filter(good).select(F.col(key).alias("_key"), fixed.alias("_c")), "fixed-point")
    schema = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    n, dim = ragged.agg(F.count("*"), F.coalesce(F.max(F.size("_c")), F.lit(0))).first()
    if not n or not dim:
        return vectors.limit(0).select(
            F.col(key), *[F.lit(None).cast(t).alias(c) for c, t in (p.split() for p in schema.split(", "))]
        )
    filled = F.concat("_c", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("_c")))
    rows = ragged.select("_key", F.when(F.size("_c") < dim, filled).otherwise(F.col("_c")).alias("_c"))
    model = fit(rows, "_c", dim, most)
    # The fixed-point numbers differ from _c by the same shift everywhere, which leaves n * x - S as it is.
    sums = (
        rows.select(F.posexplode_outer("_c").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("s")).orderBy("i").collect()
    )
    total = F.array(*[F.lit(r["s"]).cast("long") for r in sums])
    gaps = F.zip_with("_c", total, lambda c, s: F.lit(n).cast("long") * c - s)
    deviation = F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + g * g)
    shares = F.array(*[F.lit(x) for x in model.explained()])
    return (
        rows.select(F.col("_key").alias(key), deviation.alias("deviation"), model.apply("_c").alias("_w"))
        .select(key, "deviation", F.posexplode_outer("_w").alias("_i", "whitened"))
        .select(
            key,
            (F.col("_i") + 1).alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(shares, F.col("_i")).alias("explained"),
            F.lit(model.error).alias("identity_error"),
        )
    )
