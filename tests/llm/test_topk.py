import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderpost.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string"


def brute(rows, k):
    usable = [
        (i, n, [math.floor(1024 * float(np.float32(x))) for x in v])
        for n, (i, v) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, n, q in usable:
        if i is None or i % 100:
            continue
        found = [(-sum(a * b for a, b in zip(q, c)), j if j is not None else math.inf) for j, m, c in usable if m != n]
        for rank, (s, j) in enumerate(sorted(found)[:k], 1):
            out.append((i, rank, None if j == math.inf else j, -s))
    return sorted(out, key=str)


def run(spark, rows, **settings):
    frame = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
    found = topk.top_k(frame, F.pmod("vec_id", F.lit(100)) == 0, **settings)
    return sorted([tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()], key=str)


def vectors(kind, n=700, d=8):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(n, d))
    if kind == "clustered":  # cosine thresholds near 1: coordinates prune
        v = np.repeat(rng.normal(size=(7, d)), n // 7, axis=0) + 0.02 * v
    if kind == "lengths":
        v *= np.exp(rng.normal(size=(n, 1)))
    if kind == "copies":
        v[: n // 2] = v[0]
    return [(i, [float(x) for x in row]) for i, row in enumerate(v)]


@pytest.mark.parametrize("kind", ["clustered", "lengths", "copies"])
def test_equals_brute_force(spark, kind):
    rows = vectors(kind)
    assert run(spark, rows, bucket_rows=60, query_rows=3) == brute(rows, 10)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.5]), (0, [1.0, 0.5]), (100, [0.0, 0.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]),
        (4, [float("inf"), 1.0]), (None, [2.0, 2.0]), (None, [-2.0, 2.0]), (5, []), (200, None), (6, [-1.0, -1.0, 9.0]),
    ]
    assert run(spark, rows) == brute(rows, 10)
    assert run(spark, [(1, [1.0])]) == [] == run(spark, [(100, None)])
    assert run(spark, [(100, [1.0])]) == []


def test_coordinates_prune_without_loss():
    rows = vectors("clustered", 140)
    unit = np.array([v for _, v in rows])
    matrix = np.floor(1024 * unit / np.linalg.norm(unit, axis=1)[:, None]).astype(np.int64)
    norm = np.linalg.norm(matrix, axis=1)
    order = np.argsort(-norm)
    block = object.__new__(topk._Block)
    block.n, block.dim, block.norm, block.matrix = len(rows), 8, norm[order], matrix[order]
    unit = block.matrix / block.norm[:, None]
    scores = block.matrix @ matrix[0]
    least = float(np.sort(scores)[-10])
    kept = topk._candidates(matrix[0], norm[0], block, unit, least)
    assert set(np.flatnonzero(scores >= least)) <= set(kept.tolist()) and len(kept) < len(rows) // 2


def test_large_numbers(spark):
    rows = [(100, [3e6, 1.0]), (1, [2e6, 5.0]), (2, [-3e5, 1.0]), (3, [1.0, 2e9]), (4, [70.0, -70.0])]
    assert run(spark, rows) == brute(rows, 10)
    with pytest.raises(OverflowError):
        topk._long_products(np.array([[1 << 40, 1]]), np.array([1 << 40, 1]))
    assert topk._long_products(np.array([[1 << 31, -1]]), np.array([1 << 31, 5])).tolist() == [(1 << 62) - 5]
