import math

import numpy as np
import pytest

from cinderpost.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, whitened string, component string, _key string, n int"


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, v, "x", "y", "z", 0) for i, v in rows], SCHEMA).repartition(parts)


def brute(rows):
    good = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = max((len(v) for _, v in good), default=0)
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in [*v, *[0.0] * (dim - len(v))]] for _, v in good])
    return [i for i, _ in good], x


def result(spark, rows, most=32, parts=5):
    found = whitening.whitened_table(frame(spark, rows, parts), most=most)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return found.collect()


def compare(spark, rows, most=32, parts=5):
    ids, x = brute(rows)
    n, dim = x.shape
    centred = x - x.sum(axis=0) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = centred @ vectors / np.sqrt(values)
    gaps = [[n * int(a) - int(s) for a, s in zip(row, x.sum(axis=0))] for row in x]
    deviation = [sum(g * g for g in row) for row in gaps]
    at = {v: k for k, v in enumerate(ids)}
    out = result(spark, rows, most, parts)
    assert len(out) == n * min(most, dim)
    got = np.zeros((n, min(most, dim)))
    for r in out:
        k, j = at[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[k] and r["identity_error"] < 1e-9
        assert abs(r["explained"] - values[j] / values.sum()) < 1e-12
        got[k, j] = r["whitened"]
    signs = np.sign((got * white[:, : got.shape[1]]).sum(axis=0))
    assert np.abs(got * signs - white[:, : got.shape[1]]).max() < 1e-7


def test_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 12)) * np.linspace(0.5, 3, 12))]
    rows += [(400, None), (401, [None] + [1.0] * 11), (402, [math.nan] * 12), (403, [1.0] * 11 + [math.inf])]
    compare(spark, rows, most=5)
    compare(spark, rows, parts=1)


def test_many_copies_of_one_vector(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(120, 6)))]
    compare(spark, rows + [(200 + i, rows[0][1]) for i in range(200)], parts=17)


def test_vectors_without_variance(spark):
    flat = result(spark, [(1, [0.5, 0.25]), (None, [0.5, 0.25]), (1, [0.5, 0.25])])
    assert len(flat) == 6
    assert {(r["whitened"], r["deviation"], r["explained"], r["identity_error"]) for r in flat} == {(None, 0, 0.0, 0.0)}
    line = result(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(9)])
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in line)
    assert {r["explained"] for r in line if r["component"] == 1} == {1.0}


def test_odd_vectors(spark):
    assert result(spark, []) == [] == result(spark, [(1, None), (2, [None]), (3, [math.nan])]) == result(spark, [(1, [])])
    padded = result(spark, [(1, [1.0]), (2, [1.0, 2.0]), (3, []), (4, [0.5, -3.0])])
    assert len(padded) == 8 and all(r["identity_error"] < 1e-9 for r in padded)
    assert sorted(r["deviation"] for r in padded if r["component"] == 1)[0] > 0


@pytest.mark.parametrize("kind", ["full", "zero", "equal", "half", "close"])
def test_rank_one_update(kind):
    rng = np.random.default_rng(3)
    for dim in (1, 2, 7, 40):
        a = rng.normal(size=(dim, dim))
        a = {"full": a @ a.T, "zero": a * 0, "equal": 3 * np.eye(dim), "half": np.diag([2.0] * (dim // 2) + [0.0] * (dim - dim // 2)), "close": np.diag(1 + 1e-15 * np.arange(dim))}[kind]
        u = rng.normal(size=dim) * (np.arange(dim) % 3 > 0 if kind == "half" else 1)
        values, vectors = np.linalg.eigh(a)
        values, vectors = whitening.rank_one(values, vectors, vectors.T @ u, 0.7)
        whole = a + 0.7 * np.outer(u, u)
        assert np.abs(vectors * values @ vectors.T - whole).max() < 1e-12 * max(1, np.abs(whole).max())
        assert np.abs(vectors.T @ vectors - np.eye(dim)).max() < 1e-12
        assert (np.diff(values) >= 0).all()


def test_spectra_of_parts_are_those_of_all_rows():
    rng = np.random.default_rng(4)
    x = np.floor(64 * rng.normal(size=(200, 10)))
    x[50:120] = x[3]
    parts = []
    for some in np.split(x, [20, 21, 130]):
        parts.append(whitening.Spectrum.empty(10))
        for row in some:
            parts[-1].add(row)
    first, *rest = (whitening.Spectrum.unpack(p.pack(), 10) for p in parts)
    for other in rest:
        first.combine(other)
    scatter = np.cov(x.T, bias=True) * len(x)
    assert first.n == len(x) and np.abs(first.mean - x.mean(axis=0)).max() < 1e-9
    assert np.abs(first.vectors * first.values @ first.vectors.T - scatter).max() < 1e-11 * scatter.max()
