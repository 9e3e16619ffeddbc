import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cinderpost.functions import patterns as P
from cinderpost.operators import blocks, descent
from cinderpost.operators import features as E
from cinderpost.operators import tokens as K
from cinderpost.plans import experiments as runs
from cinderpost.session import stage


@pytest.fixture(scope="module")
def prepared(posts):
    return stage(K.prepare(posts), "prepared")


@pytest.fixture(scope="module")
def table(prepared):
    train = runs.part(prepared, "train")
    rows = E.FeatureBuilder().fit(train).transform_all(train, keep=("target",))
    return stage(rows.withColumn("trains", F.col("id") != 6), "rows")


LEARNERS = [
    descent.Learner("a", 0), descent.Learner("b", 1, 3), descent.Learner("c", 2, 2), descent.Learner("d", 2),
]


def dense(table):
    rows = table.orderBy("id", "feature").collect()
    names = sorted({r["feature"] for r in rows if r["trains"]})
    ids = sorted({r["id"] for r in rows})
    x = np.zeros((3, len(ids), len(names)))
    y = {r["id"]: r["target"] for r in rows}
    for r in rows:
        if r["feature"] in names:
            x[:, ids.index(r["id"]), names.index(r["feature"])] = r["v"]
    trains = np.array([i != 6 for i in ids])
    return x, np.array([y[i] for i in ids]), trains, names


def sigmoid(z):
    return 1 / (1 + np.exp(-z))


def loss(x, y, first, out, learner):
    inner = sigmoid(x @ first)
    p = sigmoid(inner @ out[:-1] + out[-1]) if learner.hidden else inner[:, 0]
    return ((p - y) ** 2).mean()


def started(table, search=descent.Search()):
    units = descent.Units(LEARNERS)
    column, outs = descent.random_start(units, search)
    names = table.filter("trains").select("feature").distinct()
    return units, {r["feature"]: np.array(r["w"]) for r in names.select("feature", column.alias("w")).collect()}, outs


@pytest.mark.parametrize("limit", [None, 0])
def test_plain_steps_equal_a_dense_computation(table, limit):
    x, y, trains, names = dense(table)
    units, begun, outs = started(table)
    found = descent.fit_many(table, LEARNERS, descent.Search(rounds=3, rate=0.5, window=9), broadcast_bytes=limit)
    # Without a better round the last one isn't kept, so the curves tell the losses of all.
    curve = {(r["run_id"], r["epoch"]): r for r in found.history.collect()}
    for learner, own, out in zip(LEARNERS, units.slices, outs):
        first, out = np.stack([begun[n][own] for n in names]), np.array(out)
        data, labels = x[learner.weighting][trains], y[trains]
        for step in range(1, 4):
            inner = sigmoid(data @ first)
            p = sigmoid(inner @ out[:-1] + out[-1]) if learner.hidden else inner[:, 0]
            slope = 2 * (p - labels) * p * (1 - p) / len(labels)
            back = slope[:, None] * out[:-1] * inner * (1 - inner) if learner.hidden else slope[:, None]
            if learner.hidden:
                out = out - 0.5 * np.append(inner.T @ slope, slope.sum())
            first = first - 0.5 * data.T @ back
            got = curve[learner.run_id, step]
            assert got["loss"] == pytest.approx(loss(data, labels, first, out, learner), rel=1e-9)


def test_quasi_newton_steps_learn_the_posts(table):
    x, y, trains, names = dense(table)
    units, begun, outs = started(table)
    found = descent.fit_many(table.withColumn("trains", F.lit(True)), LEARNERS, descent.Search(rounds=25))
    last = {}
    for r in found.history.orderBy("epoch").collect():
        assert r["loss"] <= last.get(r["run_id"], (1, 0))[0] + 1e-12
        last[r["run_id"]] = (r["loss"], r["train_acc"])
    assert all(value[0] < 0.02 and value[1] == 100.0 for value in last.values())
    weights = {r["feature"]: np.array(r["w"]) for r in found.weights.collect()}
    for learner, own, out in zip(LEARNERS, units.slices, found.outputs):
        every = sorted(weights)
        data = np.zeros((len(y), len(every)))
        ids = sorted({r["id"] for r in table.collect()})
        for r in table.collect():
            data[ids.index(r["id"]), every.index(r["feature"])] = r["v"][learner.weighting]
        first = np.stack([weights[n][own] for n in every])
        assert loss(data, y, first, np.array(out), learner) == pytest.approx(last[learner.run_id][0], rel=1e-6)


def test_two_loops_equal_the_explicit_inverse():
    rng = np.random.default_rng(1)
    n, k = 8, 3
    a = rng.normal(size=(n, n))
    a = a @ a.T + np.eye(n)
    s = rng.normal(size=(k, n))
    y, g = s @ a, rng.normal(size=n)
    h = np.eye(n) * (s[-1] @ y[-1]) / (y[-1] @ y[-1])
    for i in range(k):
        rho = 1 / (s[i] @ y[i])
        v = np.eye(n) - rho * np.outer(y[i], s[i])
        h = v.T @ h @ v + rho * np.outer(s[i], s[i])
    basis = np.concatenate([s, y, g[None, :]])
    assert np.allclose(descent._coefficients(basis @ basis.T, [0, 1, 2], k) @ basis, -h @ g)
    assert np.allclose(descent._coefficients(basis @ basis.T, [], k) @ basis, -g)


def test_scores_of_all_runs_equal_those_of_each(prepared, table):
    found = descent.fit_many(table, LEARNERS, descent.Search(rounds=4))
    test = runs.part(prepared, "test")
    built = E.FeatureBuilder().fit(runs.part(prepared, "train"))
    rows = stage(built.transform_all(test, keep=("target",)), "test-rows")
    together = {(r["run_id"], r["id"]): (r["p"], r["pred"], r["target"]) for r in found.score(rows).collect()}
    for learner in LEARNERS:
        own = rows.withColumn("value", F.get("v", F.lit(learner.weighting)))
        alone = found.model(learner.run_id).score(stage(own, "own")).collect()
        assert len(alone) == 4
        for r in alone:
            p, pred, target = together[learner.run_id, r["id"]]
            assert p == pytest.approx(r["p"]) and (pred, target) == (r["pred"], r["target"])
    bare = found.score(rows.drop("target"))
    assert bare.columns == ["run_id", "id", "p", "pred"] and bare.count() == 16


def test_a_search_trains_an_experiment(prepared):
    how = runs.Experiment("NoStem", "Binary", "FFNN", search=descent.Search(rounds=5))
    assert how.model_id != runs.Experiment("NoStem", "Binary", "FFNN").model_id
    trained = runs.train(prepared, how)
    assert trained.predict(runs.part(prepared, "test")).count() == 4
    on_test = runs.train(prepared, runs.Experiment("NoStem", "Binary", "Logistic", select_on="test", search=descent.Search(rounds=5)))
    assert 1 <= on_test.history.count() <= 5


def test_grid_has_a_row_for_every_combination(posts):
    report = runs.run_grid(posts, search=descent.Search(rounds=3)).collect()
    assert len(report) == len({r["run_id"] for r in report}) == 18
    assert all(r["tn"] + r["fn"] + r["fp"] + r["tp"] == 4 for r in report)
    assert {r["run_id"].split("-")[1] for r in report} == set(P.WEIGHTINGS)


@pytest.mark.parametrize("limit", [0, 2000])
def test_what_a_round_writes_has_a_row_per_post(table, monkeypatch, limit):
    """Rare features apart, slopes broadcast (2000) or not (0): the same runs, nothing kept by feature."""
    plain = descent.fit_many(table, LEARNERS, descent.Search(rounds=4))
    written = {}

    def noted(df, name, *more):
        found = stage(df, name, *more)
        written.setdefault(name, set()).add(found.count())
        return found

    monkeypatch.setattr(descent, "stage", noted)
    found = descent.fit_many(table, LEARNERS, descent.Search(rounds=4), broadcast_bytes=limit)
    once = ("train-features", "weights")
    assert {n for name, counts in written.items() if name not in once for n in counts} <= {5, 6}
    expected = {r["feature"]: r["w"] for r in plain.weights.collect()}
    for r in found.weights.collect():
        assert np.allclose(r["w"], expected.pop(r["feature"]), atol=1e-7)
    assert not expected


@pytest.mark.parametrize("limit", [50, 100])
def test_groups_of_units_give_what_one_pass_gives(table, limit):
    """One (50) or two (100) of seven units at a time, sums of tasks added by a shuffle."""
    plain = descent.fit_many(table, LEARNERS, descent.Search(rounds=4))
    found = descent.fit_many(table, LEARNERS, descent.Search(rounds=4), broadcast_bytes=limit)
    expected = {r["feature"]: r["w"] for r in plain.weights.collect()}
    for r in found.weights.collect():
        assert np.allclose(r["w"], expected.pop(r["feature"]), atol=1e-7)
    assert not expected


def test_no_round_joins_rows_while_a_unit_of_all_posts_fits(table, monkeypatch):
    def joined(*_):
        raise AssertionError("rows are joined in every round")

    monkeypatch.setattr(descent, "placed_rows", joined)
    found = descent.fit_many(table, LEARNERS, descent.Search(rounds=2))
    assert found.history.select("run_id").distinct().count() == len(LEARNERS)


def test_blocks_hold_whole_features_that_train(monkeypatch):
    monkeypatch.setattr(blocks, "ROWS", 3)
    rows = [("a", 0, True), ("a", 2, False), ("b", 1, False), ("c", 0, True), ("c", 1, True), ("d", 2, True)]
    numbers = pa.list_(pa.float64())
    kinds = pa.schema([("feature", pa.string()), ("place", pa.int32()), ("trains", pa.bool_()), ("v", numbers), ("w", numbers)])
    packer, found = blocks._Packer(1, 2), []
    for k, (name, place, trains) in enumerate(rows):
        first = name not in [r[0] for r in rows[:k]]
        row = {"feature": name if first else None, "place": place, "trains": trains, "v": [k + 0.5], "w": [float(k), -float(k)] if first else None}
        batch = pa.RecordBatch.from_pylist([row], schema=kinds)
        if packer.full() and first:
            found.append(packer.block())
        packer.add(batch, np.array([first]))
    found = [b.to_pylist()[0] for b in (*found, packer.block()) if b is not None]
    # The first block ends with b, which no training post has.
    assert [b["names"] for b in found] == [["a"], ["c", "d"]]
    assert [np.frombuffer(b["sizes"], np.int32).tolist() for b in found] == [[2], [2, 1]]
    assert [np.frombuffer(b["places"], np.int32).tolist() for b in found] == [[0, 2], [0, 1, 2]]
    assert np.frombuffer(found[1]["v"][0]).tolist() == [3.5, 4.5, 5.5]
    assert [np.frombuffer(x).tolist() for x in found[1]["w"]] == [[3.0, 5.0], [-3.0, -5.0]]


def test_grid_tokenizes_a_post_once_and_counts_its_features_once(posts, monkeypatch):
    tokenized, counted = [], []
    tokenize, count = K.with_tokens, E.feature_dictionary

    def read(df, *options):
        tokenized.append(df.count())
        return tokenize(df, *options)

    monkeypatch.setattr(K, "with_tokens", read)
    monkeypatch.setattr(E, "feature_dictionary", lambda rows: counted.append(1) or count(rows))
    report = runs.run_grid(posts, search=descent.Search(rounds=1, rate=0.5), select_on="last").collect()
    assert len(report) == 18 and tokenized == [posts.count()] and not counted
