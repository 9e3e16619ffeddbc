import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderpost.operators import batches, lookup, network
from cinderpost.operators import features as E
from cinderpost.operators import tokens as K
from cinderpost.plans import experiments as runs
from cinderpost.session import stage


def test_permutation_has_the_order_of_digests(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(500)], "id long, other int").repartition(6)
    found = {r["id"]: r["place"] for r in batches.permutation(df, 5).collect()}
    wanted = sorted(range(500), key=lambda i: hashlib.md5(f"5|{i}".encode()).hexdigest())
    assert found == {i: place for place, i in enumerate(wanted)}
    assert [r["id"] for r in batches.shuffled(df, 5).collect()] == wanted
    assert {r["id"]: r["place"] for r in batches.permutation(df, 6).collect()} != found


def test_permutation_of_equal_and_missing_keys(spark):
    df = spark.createDataFrame([(k,) for k in [None, None, 1, 1, 1, 2]], "id long")
    rows = batches.permutation(df, 1).collect()
    assert sorted(r["place"] for r in rows) == list(range(6))
    for key in (None, 1):  # equal keys stand beside each other
        own = sorted(r["place"] for r in rows if r["id"] == key)
        assert own == list(range(own[0], own[0] + len(own)))
    assert batches.permutation(df.limit(0), 1).count() == 0


def dense(x, y, order, first, output, hidden, rate, epochs):
    for _ in range(epochs):
        for batch in order:
            a, t = x[batch], y[batch]
            inner = 1 / (1 + np.exp(-(a @ first)))
            p = 1 / (1 + np.exp(-(inner @ output[:-1] + output[-1]))) if hidden else inner[:, 0]
            slope = 2 * (p - t) * p * (1 - p) / len(t)
            back = slope[:, None] * output[:-1] * inner * (1 - inner) if hidden else slope[:, None]
            if hidden:
                output = output - rate * np.append(inner.T @ slope, slope.sum())
            first = first - rate * a.T @ back
    return first, output


@pytest.mark.parametrize("hidden", [0, 2])
def test_steps_by_batch_equal_a_dense_computation(spark, posts, hidden):
    prepared = stage(K.prepare(posts), "prepared")
    train = runs.part(prepared, "train")
    rows = stage(E.FeatureBuilder("Frequency").fit(train).transform(train, keep=("target",)), "rows")
    names, ids = (sorted({r[c] for r in rows.collect()}) for c in ("feature", "id"))
    x, y = np.zeros((len(ids), len(names))), np.zeros(len(ids))
    for r in rows.collect():
        x[ids.index(r["id"]), names.index(r["feature"])] = r["value"]
        y[ids.index(r["id"])] = r["target"]
    start = stage(network.initial_weights(rows.select("feature").distinct(), network.Settings(hidden=hidden, start=0.2)), "start")
    before = {r["feature"]: np.array(r["w"]) for r in start.collect()}
    placed = stage(batches.shuffled_minibatches(train.select("id"), 3, 4), "places")
    order = {r["id"]: r["batch"] for r in placed.collect()}
    found = {r["feature"]: r["w"] for r in batches.batch_descent(rows, placed, start, hidden, 0.5, 2).collect()}
    groups = [[ids.index(i) for i in ids if order[i] == b] for b in range(2)]
    first, output = dense(x, y, groups, np.stack([before[n] for n in names]), before.get(network.OUTPUT), hidden, 0.5, 2)
    assert all(np.allclose(found[n], w) for n, w in zip(names, first))
    assert not hidden or np.allclose(found[network.OUTPUT], output)


def test_weights_too_large_to_broadcast_meet_rare_features_elsewhere(spark, monkeypatch):
    monkeypatch.setattr(lookup, "HOT_KEYS", 3)
    cells = [(i, i % 2, f, 1.0) for i in range(24) for f in (E.BIAS, f"w:{i}", f"w:common{i % 3}")]
    rows = stage(spark.createDataFrame(cells, "id long, target int, feature string, value double"), "rows")
    start = stage(rows.select("feature").distinct().selectExpr("feature", "array(length(feature) / 8.0D) AS w"), "start")
    placed = stage(spark.range(24).select("id", F.floor(F.col("id") / 8).alias("batch")), "places")
    weights = lambda **limit: {r["feature"]: r["w"] for r in batches.batch_descent(rows, placed, start, 0, 0.5, 2, **limit).collect()}
    plain = weights()
    for limit in (0, 1200):
        with batches.batched_rows(rows, placed, start, limit) as laid:
            assert laid.hot.count() == (1 if limit == 0 else 4)
            assert laid.read(1).rare.count() == (16 if limit == 0 else 8)
        again = weights(broadcast_bytes=limit)
        assert again.keys() == plain.keys() and all(np.allclose(again[f], w) for f, w in plain.items())


def test_a_large_batch_lies_in_several_files(spark):
    rows = spark.range(4000).selectExpr("id", "1 AS target", f"'{E.BIAS}' AS feature", "1.0D AS value")
    held = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with batches.batched_rows(rows, spark.range(4000).selectExpr("id", "id % 2 AS batch")) as laid:
            own = laid.read(1).by_post
            assert own.count() == 2000 and own.select(F.input_file_name()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)


def test_a_step_reads_its_batch_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batches, "SHELF", 2)
    rows = spark.createDataFrame([(i, 1, f, 1.0) for i in range(40) for f in (E.BIAS, f"w:{i}")], "id long, target int, feature string, value double")
    placed = spark.range(40).select("id", F.floor(F.col("id") / 5).alias("batch"))
    with batches.batched_rows(rows, placed) as laid:
        assert laid.batches == 8
        own = laid.read(3).by_post
        assert sorted({r["id"] for r in own.collect()}) == list(range(15, 20))
        plan = own._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(shelf" in plan and "EqualTo(batch,3)" in plan
