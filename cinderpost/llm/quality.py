"""Quality classifier: non-negative positive-unlabelled learning on the form of texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderpost.session import discard, ship_package, stage

FOLDS, HELD_OUT = 3, 1
RIDGE = 1e-4
# The kink of the risk is rounded off over these widths in turn; the last is what remains.
WIDTHS = (1e-1, 1e-2, 1e-3, 1e-4)
# A step that promises to lower the risk by less than this ends the search.
SETTLED = 1e-8
ROUNDS = 100
STEPS = tuple(0.5**i for i in range(1, 21))
# Class prior: bins of the score, and the least share of the positives above a threshold.
BINS = 1000
LEAST_POSITIVES = 0.1


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose labels are never learned from."""
    digest = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(digest % FOLDS == HELD_OUT, F.lit(False))


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def with_features(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """Add the form of each whole text as numbers __f*; null counts as empty.

    Shares enter as square roots, so that a small share of odd signs already counts.
    """
    t, n = F.col("__t"), F.col("__n")
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]+", ""))
    upper = F.length(F.regexp_replace(t, r"[^\p{Lu}]+", ""))
    digits = F.length(F.regexp_replace(t, r"[^\p{N}]+", ""))
    signs = F.length(F.regexp_replace(t, r"[\p{L}\p{N}\p{M}\s.,;:'()\-]+", ""))
    bars = n - F.length(F.replace(t, F.lit("|"), F.lit("")))
    stops = F.regexp_count(t, F.lit(r"[.!?](?:\s|$)"))
    ends = F.regexp_count(t, F.lit(r"[^\p{L}\p{N}\s.,;:'()\-](?:\s|$)"))
    words, many = F.col("__w"), F.size("__w")
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(many, F.lit(1))), lambda a, b: a == b)
    same = F.size(F.filter(pairs, lambda x: x))
    kinds = F.size(F.array_distinct(words))
    features = [
        F.sqrt(_share(upper, letters)),
        _share(upper, letters),
        F.sqrt(_share(digits, n)),
        F.sqrt(_share(signs, n)),
        F.least(_share(signs, n) * 10, F.lit(1.0)),
        F.sqrt(_share(bars, n)),
        F.least(_share(bars, n) * 20, F.lit(1.0)),
        F.sqrt(_share(same, many)),
        F.least(_share(same, many) * 3, F.lit(1.0)),
        F.sqrt(_share(ends, many)),
        F.least(_share(ends, many) * 2, F.lit(1.0)),
        _share(F.log1p(kinds), F.log1p(many)),
        _share(kinds, many),
        F.least(_share(letters, many) / 10, F.lit(2.0)),
        F.least(F.sqrt(_share(stops, many)), F.lit(1.0)),
        F.log1p(many) / 10,
    ]
    names = [f"__f{i}" for i in range(len(features))]
    frame = (
        docs.withColumn("__t", F.coalesce(F.col(text), F.lit("")))
        .withColumn("__n", F.length("__t"))
        .withColumn("__w", F.regexp_extract_all("__t", F.lit(r"\S+"), F.lit(0)))
    )
    frame = frame.withColumns({c: f.cast("double") for c, f in zip(names, features)})
    return frame.drop("__t", "__n", "__w"), names


def _tally(values: Iterator[np.ndarray], width: int) -> Iterator[pd.DataFrame]:
    total = np.zeros(width)
    for v in values:
        total += v
    yield pd.DataFrame({"i": np.arange(width), "v": total})


def _summed(rows: DataFrame, part, width: int) -> np.ndarray:
    """Sum over all rows of what ``part`` makes of a matrix (and the positives' flags)."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def made():
            for batch in batches:
                flags = batch.pop("__positive").to_numpy(bool)
                yield part(batch.to_numpy(np.float64), flags)

        yield from _tally(made(), width)

    sums = rows.mapInPandas(each, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    out = np.zeros(width)
    for r in sums.collect():  # one row per entry of the sum
        out[r["i"]] = r["v"]
    return out


def _log_loss(g: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, -g)


def _chance(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -500, 500)))


@dataclass
class Quality:
    """A trained linear model over standardized features."""

    names: list[str]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def score(self) -> Column:
        """Probability of the positive class, to six places."""
        g = F.lit(float(self.weights[0]))
        for name, m, s, w in zip(self.names, self.mean, self.scale, self.weights[1:]):
            g = g + (F.col(name) - float(m)) * float(w / s)
        return F.round(1 / (1 + F.exp(-F.greatest(F.least(g, F.lit(500.0)), F.lit(-500.0)))), 6)


@dataclass
class _Sums:
    """What a pass leaves of all rows at some weights: losses, slopes, curvatures.

    ``gain`` is the loss of the positives as positives, ``rest`` the estimated loss of the
    negatives; both convex parts of the risk curve alike, so its curvature is never negative.
    """

    gain: float
    rest: float
    d_gain: np.ndarray
    d_rest: np.ndarray
    curve_pos: np.ndarray
    curve_all: np.ndarray

    def rounded(self, width: float) -> float:
        """The risk with its kink rounded off, without the ridge."""
        return self.gain + width * float(np.logaddexp(0.0, self.rest / width))

    def step(self, width: float, weights: np.ndarray) -> tuple[np.ndarray, float]:
        """Newton step, and the fall of the risk that it promises."""
        on = float(_chance(np.array(self.rest / width)))
        grad = self.d_gain + on * self.d_rest + 2 * RIDGE * weights
        curve = (1 - on) * self.curve_pos + on * self.curve_all + 2 * RIDGE * np.eye(len(grad))
        curve += on * (1 - on) / width * np.outer(self.d_rest, self.d_rest)
        move = np.linalg.solve(curve, grad)
        return move, float(grad @ move) / 2


def _least_risk(table: DataFrame, design, k: int, n: float, positives: float, prior: float) -> np.ndarray:
    """Weights of the least non-negative risk: prior E+[l(g)] + max(0, E[l(-g)] - prior E+[l(-g)]).

    With the logistic loss that is the larger of two convex functions. The larger one is rounded
    off over a width that narrows to WIDTHS[-1], which changes the risk by less than the width,
    and each rounded risk is minimised by Newton steps that are halved until it falls.
    """

    def sums(w: np.ndarray) -> _Sums:
        def part(x, flags):
            a = design(x)
            g = a @ w
            p = _chance(g)
            v = (p * (1 - p))[:, None]
            ap, gp, pp = a[flags], g[flags], p[flags]
            numbers = [_log_loss(gp).sum(), _log_loss(-gp).sum(), _log_loss(-g).sum()]
            slopes = [ap.T @ (pp - 1), ap.T @ pp, a.T @ p]
            curves = [((ap * v[flags]).T @ ap).ravel(), ((a * v).T @ a).ravel()]
            return np.concatenate([numbers, *slopes, *curves])

        s = _summed(table, part, 3 + 3 * k + 2 * k * k)
        share = prior / positives
        gp, up, ua = s[3 : 3 + 3 * k].reshape(3, k)
        cp, ca = s[3 + 3 * k :].reshape(2, k, k)
        return _Sums(share * s[0], s[2] / n - share * s[1], share * gp, ua / n - share * up, share * cp, ca / n)

    def risks(tries: np.ndarray, width: float) -> np.ndarray:
        def part(x, flags):
            g = design(x) @ tries.T
            pos = g[flags]
            return np.concatenate([_log_loss(pos).sum(0), _log_loss(-pos).sum(0), _log_loss(-g).sum(0)])

        s = _summed(table, part, 3 * len(tries)).reshape(3, len(tries))
        rest = s[2] / n - prior * s[1] / positives
        return prior * s[0] / positives + width * np.logaddexp(0.0, rest / width) + RIDGE * (tries**2).sum(axis=1)

    w = np.zeros(k)
    here, rounds = sums(w), 0
    for width in WIDTHS:
        while True:
            move, fall = here.step(width, w)
            if fall < SETTLED:
                break
            if rounds == ROUNDS:
                raise RuntimeError(f"the risk is not settled after {ROUNDS} rounds")
            rounds += 1
            risk = lambda at, s: s.rounded(width) + RIDGE * float(at @ at)
            ahead = sums(w - move)
            if risk(w - move, ahead) > risk(w, here) - fall / 2:
                tries = np.stack([w - t * move for t in STEPS])
                found = risks(tries, width)
                enough = found <= risk(w, here) - np.array(STEPS) * fall / 2
                if not enough.any():
                    break  # what the step promises is below the precision of the sums
                w = tries[int(np.argmax(enough))]
                here = sums(w)
            else:
                w, here = w - move, ahead
    return w


def _apart(table: DataFrame, design, k: int, n: float, positives: float) -> np.ndarray:
    """Weights that tell positives from all text, both counting the same, by logistic regression."""

    def sums(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def part(x, flags):
            a = design(x)
            g = a @ w
            p = _chance(g)
            out = []
            for rows_, at, slope in ((flags, g, p - 1), (slice(None), -g, p)):
                b = a[rows_]
                v = (p * (1 - p))[rows_][:, None]
                out += [[_log_loss(at[rows_]).sum()], b.T @ slope[rows_], ((b * v).T @ b).ravel()]
            return np.concatenate(out)

        s = _summed(table, part, 2 * (1 + k + k * k)).reshape(2, -1)
        s = s[0] / positives + s[1] / n
        return (
            float(s[0] + RIDGE * w @ w),
            s[1 : 1 + k] + 2 * RIDGE * w,
            s[1 + k :].reshape(k, k) + 2 * RIDGE * np.eye(k),
        )

    w = np.zeros(k)
    loss, grad, curve = sums(w)
    for _ in range(ROUNDS):
        move = np.linalg.solve(curve, grad)
        if float(grad @ move) / 2 < SETTLED:
            return w
        size, after = 1.0, sums(w - move)
        while after[0] > loss and size > 1e-6:
            size /= 2
            after = sums(w - size * move)
        w, (loss, grad, curve) = w - size * move, after
    raise RuntimeError(f"positives and all text are not told apart after {ROUNDS} rounds")


def _class_prior(table: DataFrame, design, w: np.ndarray, n: float, positives: float) -> float:
    """Share of positives in the unlabelled text, from positives and unlabelled text alone.

    ``w`` tells positives from unlabelled text. Above any threshold of its score lie a share of
    the positives and at least the prior times that share of all text; the threshold that has
    least text for its positives, with a margin for chance, gives the estimate.
    """
    scale = np.linalg.norm(w[1:]) or 1.0

    def part(x, flags):
        g = design(x) @ w / scale
        place = np.clip((_chance(g) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(place, minlength=BINS), np.bincount(place[flags], minlength=BINS)])

    every, own = _summed(table, part, 2 * BINS).reshape(2, BINS)[:, ::-1].cumsum(axis=1) / [[n], [positives]]
    margin = np.sqrt(np.log(BINS) / 2) * (1 / np.sqrt(n) + 1 / np.sqrt(positives))
    good = own >= min(LEAST_POSITIVES + margin, 1.0)
    ratio = every[good] / own[good]
    bound = (every[good] + margin) / own[good]
    return float(np.clip(ratio[int(bound.argmin())], 1 / (n + 1), 1 - 1 / (n + 1)))


def fit(rows: DataFrame, names: list[str], prior: float | None = None) -> Quality:
    """Minimise the non-negative risk of positive-unlabelled learning over all rows.

    ``rows`` (a written table) has the features and __positive; every row is part of the
    unlabelled text, the flagged ones are the trusted positives as well. With the logistic loss
    l and the class prior p the risk is

        p E_pos[l(g)] + max(0, E_unl[l(-g)] - p E_pos[l(-g)])  (+ a small ridge)

    The estimate of the negatives' risk can't fall below zero, which keeps the model from
    fitting the positives by heart. Without a given ``prior`` it is estimated first, by a
    classifier of positives against all text, from where both have their scores. A search that
    doesn't settle is an error. Each round is a pass, which leaves some hundred sums to the
    driver, whatever the input.
    """
    d = len(names)
    table = rows.select("__positive", *names)

    def moments(x, flags):
        return np.concatenate([[len(x), flags.sum()], x.sum(axis=0), (x * x).sum(axis=0)])

    first = _summed(table, moments, 2 + 2 * d)
    n, positives = first[0], first[1]
    mean = first[2 : 2 + d] / max(n, 1)
    scale = np.sqrt(np.maximum(first[2 + d :] / max(n, 1) - mean**2, 0))
    scale = np.where(scale > 1e-9, scale, 1.0)
    if not positives:
        return Quality(names, mean, scale, np.zeros(d + 1), 0.5 if prior is None else prior)

    def design(x):
        return np.hstack([np.ones((len(x), 1)), (x - mean) / scale])

    if prior is None:
        apart = _apart(table, design, d + 1, n, positives)
        prior = _class_prior(table, design, apart, n, positives)
    return Quality(names, mean, scale, _least_risk(table, design, d + 1, n, positives, prior), prior)


def _trained(features: DataFrame, names: list[str], labels: DataFrame) -> Quality:
    """The model of a written table with doc_id and features, on its rows that aren't held out."""
    marks = stage(
        labels.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg((F.min("quality") >= 1).alias("__positive")),
        "quality-labels",
    )
    rows = stage(
        features.filter(~held_out())
        .select("doc_id", *names)
        .join(marks, "doc_id", "left")
        .select(F.coalesce("__positive", F.lit(False)).alias("__positive"), *names),
        "quality-training",
    )
    model = fit(rows, names)
    discard(rows, marks)
    return model


def train(docs: DataFrame, labels: DataFrame) -> tuple[Quality, DataFrame]:
    """The model, and the written features of all documents (doc_id, __f*).

    Labels of held-out documents are never read. Trusted positives are labelled 1 (in every row,
    if there are several); other labels are not used, the class prior is estimated. The
    unlabelled text is that of all documents that aren't held out. Without positives every score
    is 0.5.
    """
    ship_package(docs.sparkSession)
    frame, names = with_features(docs.select("doc_id", "text"))
    features = stage(frame.select("doc_id", *names), "quality-features")
    return _trained(features, names, labels), features


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.5) of every document.

    Scores see the text only. Null and empty texts have the score of an empty text; rows count
    as they come; labels without a document are left out; extra columns are ignored.
    """
    model, features = train(docs, labels)
    return features.select("doc_id", held_out().alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the trained model accepts, with their columns as they are.

    Features are computed once and written beside the documents, which are then filtered where
    they lie. Names of columns that begin with two underscores are reserved.
    """
    ship_package(docs.sparkSession)
    frame, names = with_features(docs)
    written = stage(frame, "quality-documents")
    model = _trained(written, names, labels)
    return written.filter(model.score() >= 0.5).select(*docs.columns)
