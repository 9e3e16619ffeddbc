"""Naive Bayes, linear and network models against plain Python; experiments, stores, streams."""

import math
import os
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from cinderpost.functions import patterns as P
from cinderpost.functions.scoring import first_argmax, threshold
from cinderpost.operators import features as E
from cinderpost.operators import descent, labeling, linear, lookup, metadata, naive_bayes, network, sequence, vocab
from cinderpost.operators import tokens as K
from cinderpost.plans import experiments as runs
from cinderpost.session import stage
from cinderpost.sources import posts as src
from cinderpost.sources.stages import StageStore, fingerprint
from cinderpost.streaming import posts as live


@pytest.fixture(scope="module")
def prepared(posts):
    return stage(K.prepare(posts), "test-prepared")


@pytest.fixture(scope="module")
def rows(prepared):
    """Training feature rows by weighting, as a matrix with its column names."""
    train = runs.part(prepared, "train")

    def matrix(weighting):
        model = E.FeatureBuilder(weighting).fit(train)
        found = model.transform(train, keep=("target",)).filter(F.col("feature") != E.BIAS)
        names = sorted(
            r["feature"] for r in model.dictionary.collect() if r["feature"] != E.BIAS
        )
        x = np.zeros((6, len(names)))
        y = np.zeros(6)
        for r in found.collect():
            x[r["id"] - 1, names.index(r["feature"])] = r["value"]
            y[r["id"] - 1] = r["target"]
        return x, y, names

    return matrix


@pytest.mark.parametrize("weighting", P.WEIGHTINGS)
def test_likelihood_equals_dense_computation(prepared, rows, weighting):
    x, y, names = rows(weighting)
    model = naive_bayes.fit(runs.part(prepared, "train"))
    found = {r["feature"]: (r["ll0"], r["ll1"]) for r in model.likelihood(weighting).collect()}
    assert sorted(found) == names
    for label in (0, 1):
        sums = x[y == label].sum(axis=0) + 1
        wanted = np.log(sums / sums.sum())
        assert np.allclose([found[n][label] for n in names], wanted)
    prior = {r["label"]: r["log_prior"] for r in model.prior().collect()}
    assert prior == {0: pytest.approx(math.log(0.5)), 1: pytest.approx(math.log(0.5))}


def test_likelihood_equals_spark_ml(spark, prepared, rows):
    x, y, names = rows("Frequency")
    df = spark.createDataFrame([(float(t), v.tolist()) for t, v in zip(y, x)], "label double, v array<double>")
    theta = NaiveBayes().fit(df.select("label", array_to_vector("v").alias("features"))).theta.toArray()
    model = naive_bayes.fit(runs.part(prepared, "train"))
    found = {r["feature"]: (r["ll0"], r["ll1"]) for r in model.likelihood("Frequency").collect()}
    assert np.allclose(theta.T, [found[n] for n in names])


def test_empty_posts_and_ties(spark, prepared):
    model = naive_bayes.fit(runs.part(prepared, "train"))
    blank = spark.createDataFrame(
        [(1, "no such keyword", 0, 0, [], 0)],
        "id long, keyword string, loc int, url int, tokens array<string>, target int",
    )
    scored = naive_bayes.predict(naive_bayes.score(blank, model, ("Frequency",))).first()
    assert scored["score0"] == pytest.approx(math.log(0.5)) and scored["pred"] == 0


@pytest.mark.parametrize("classifier", ["NaiveBayes", "Logistic"])
def test_unmatched_labels_are_refused(prepared, classifier):
    wrong = prepared.withColumn("target", F.lit(-1))
    short = network.Settings(rounds=1)
    experiment = runs.Experiment("NoStem", "Binary", classifier, select_on="test", network=short)
    with pytest.raises(Exception, match="target outside 0/1"):
        runs.train(wrong, experiment)


def test_threshold_and_argmax(spark):
    df = spark.createDataFrame([(0.5, [1.0, 3.0, 3.0])], "p double, s array<double>")
    row = df.select(threshold(F.col("p")).alias("t"), first_argmax(F.col("s")).alias("a")).first()
    assert (row["t"], row["a"]) == (0, 1)


def test_gradient_step_lowers_the_error(spark, prepared, rows):
    x, y, names = rows("Binary")
    train = runs.part(prepared, "train")
    table = stage(
        E.FeatureBuilder("Binary").fit(train).transform(train, keep=("target",)), "rows"
    )
    weights = table.select("feature").distinct().withColumn("w", F.lit(0.25))
    found = {r["feature"]: r["w"] for r in linear.mse_gradient_step(table, weights, 0.1).collect()}
    p = 1 / (1 + np.exp(-(0.25 * x.sum(axis=1) + 0.25)))
    slope = 2 * (p - y) * p * (1 - p) / 6
    assert found["1"] == pytest.approx(0.25 - 0.1 * slope.sum())
    used = [n for n in names if n in found]
    wanted = 0.25 - 0.1 * (x.T @ slope)
    assert np.allclose([found[n] for n in used], [wanted[names.index(n)] for n in used])


def dense_steps(x, y, first, output, hidden, rate, steps):
    """Full-batch steps over a dense matrix whose last column is the bias."""
    for _ in range(steps):
        inner = 1 / (1 + np.exp(-(x @ first)))
        p = inner[:, 0] if not hidden else 1 / (1 + np.exp(-(inner @ output[:-1] + output[-1])))
        slope = 2 * (p - y) * p * (1 - p) / len(y)
        back = slope[:, None]
        if hidden:
            back = slope[:, None] * output[:-1] * inner * (1 - inner)
            output = output - rate * np.append(inner.T @ slope, slope.sum())
        first = first - rate * (x.T @ back)
    return first, output


def feature_rows(prepared, weighting="Frequency"):
    train = runs.part(prepared, "train")
    built = E.FeatureBuilder(weighting).fit(train).transform(train, keep=("target",))
    return stage(built, "rows")


@pytest.mark.parametrize("hidden", [0, 3])
@pytest.mark.parametrize("limit", [None, 0])
def test_steps_equal_a_dense_computation(prepared, rows, hidden, limit):
    x, y, names = rows("Frequency")
    x = np.hstack([x, np.ones((6, 1))])
    table = feature_rows(prepared)
    settings = network.Settings(hidden=hidden, seed=11)
    start = stage(network.initial_weights(table.select("feature").distinct(), settings), "start")
    before = {r["feature"]: np.array(r["w"]) for r in start.collect()}
    found = network.descend(table, start, hidden, 0.5, 2, limit)
    after = {r["feature"]: np.array(r["w"]) for r in found.collect()}
    width = max(hidden, 1)
    first = np.stack([before.get(n, np.zeros(width)) for n in [*names, E.BIAS]])
    first, output = dense_steps(x, y, first, before.get(network.OUTPUT), hidden, 0.5, 2)
    for name, wanted in zip([*names, E.BIAS], first):
        if name in after:
            assert np.allclose(after[name], wanted)
    if hidden:
        assert np.allclose(after[network.OUTPUT], output)


def test_weights_depend_on_the_posts_alone(prepared):
    """Neither the spread of the rows nor copies of the whole collection change a weight."""
    table = feature_rows(prepared)
    start = stage(network.initial_weights(table.select("feature").distinct(), network.Settings(hidden=2)), "start")
    copies = table.unionByName(table.withColumn("id", F.col("id") + 100))
    spread = table.repartition(7)
    get = lambda t: {r["feature"]: r["w"] for r in network.descend(stage(t, "r"), start, 2, 0.5, 2).collect()}
    plain, doubled, dealt = get(table), get(copies), get(spread)
    for name, w in plain.items():
        assert np.allclose(doubled[name], w) and np.allclose(dealt[name], w)


def test_steps_above_the_broadcast_limit_shuffle_no_rows_by_post(prepared):
    table = feature_rows(prepared)
    start = stage(network.initial_weights(table.select("feature").distinct(), network.Settings()), "start")
    with network.training_rows(table, 0, 0) as placed:
        assert placed.rare is not None
        near = placed.by_post.join(start, "feature").groupBy("id").count()
        plan = placed.by_post.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and near.count() == 6
        after, _ = network.gradient_step(placed, start, 0, 0.5)
        assert after.count() == start.count()


def test_training_stops_early_and_keeps_the_best_round(prepared):
    table = feature_rows(prepared)
    settings = network.Settings(rate=1.0, rounds=9, window=3, start=0.01)
    model = network.fit(table, table, settings, "run")
    curve = [r["test_acc"] for r in model.history.orderBy("epoch").collect()]
    assert len(curve) == 9 and max(curve) > 80
    flipped = table.withColumn("target", 1 - F.col("target"))
    stopped = network.fit(table, flipped, settings, "run").history.orderBy("epoch").collect()
    values = [r["test_acc"] for r in stopped]
    ends = [i for i in range(2, len(values)) if values[i] < min(values[i - 2 : i])]
    assert (ends[0] + 1 if ends else 9) == len(values)


def test_rates_follow_the_classifier():
    short = network.Settings(rounds=50)
    assert runs.Experiment(classifier="FFNN", network=short).settings().step == 0.5
    assert runs.Experiment(classifier="Logistic", network=short).settings().step == 0.1
    given = network.Settings(rate=0.2)
    assert runs.Experiment(classifier="FFNN", network=given).settings().step == 0.2


@pytest.mark.parametrize("classifier", P.CLASSIFIERS)
def test_posts_without_labels_get_predictions(posts, prepared, classifier):
    short = network.Settings(rounds=1)
    trained = runs.train(prepared, runs.Experiment(classifier=classifier, select_on="test", network=short))
    fresh = K.prepare(posts.drop("target"))
    with_labels = {r["id"]: r["pred"] for r in trained.predict(prepared).collect()}
    found = trained.predict(stage(fresh, "fresh"))
    assert found.columns == ["run_id", "id", "pred"]
    assert {r["id"]: r["pred"] for r in found.collect()} == with_labels


def test_word_vectors(prepared):
    terms = vocab.vocabulary(prepared)
    table = stage(sequence.random_embedding(terms, 16), "vectors")
    vectors = np.array([r["vec"] for r in table.collect()])
    assert vectors.shape[1] == 16 and abs(vectors.mean()) < 0.2 and 0.8 < vectors.std() < 1.2
    again = {r["term"]: r["vec"] for r in sequence.random_embedding(terms, 16).collect()}
    assert {r["term"]: r["vec"] for r in table.collect()} == again
    pooled = sequence.pool_posts(prepared, table)
    found = {r["id"]: r["m"] for r in pooled.select("id", vector_to_array("features").alias("m")).collect()}
    tokens = {r["id"]: r["tokens"] for r in prepared.collect()}
    assert np.allclose(found[2], np.mean([again[t] for t in tokens[2]], axis=0), atol=1e-5)
    assert list(found[9]) == [0.0] * 16 and len(found) == 10


def test_counted_weights_need_no_pass_over_the_rows(spark, monkeypatch):
    cells = [(i, i % 2, f, 1.0) for i in range(12) for f in (E.BIAS, f"w:{i}")]
    rows = stage(spark.createDataFrame(cells, "id long, target int, feature string, value double"), "rows")
    counted = rows.groupBy("feature").agg(F.count("*").alias("df"), F.array(F.max(F.length("feature")) / 8.0).alias("w"))
    weights = stage(counted, "weights")
    plain = {r["id"]: r["p"] for r in network.NetworkModel(weights.drop("df"), 0).score(rows).collect()}
    flat = stage(weights.select("feature", "df", F.get("w", F.lit(0)).alias("w")), "flat")
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup, "hot_keys", lambda *_: pytest.fail("counted again"))
    assert {r["id"]: r["p"] for r in network.NetworkModel(weights, 0).score(rows).collect()} == plain
    assert {r["id"]: r["p"] for r in linear.logistic_score(rows, flat).collect()} == plain


def test_frequent_features_of_a_descent_stay_with_their_posts(spark, monkeypatch):
    monkeypatch.setattr(lookup, "HOT_KEYS", 2)
    cells = [(i, i % 2, f, 1.0) for i in range(24) for f in (E.BIAS, f"w:{i}", f"w:common{i % 3}")]
    rows = stage(spark.createDataFrame(cells, "id long, target int, feature string, value double"), "rows")
    given = stage(rows.select("feature").distinct().selectExpr("feature", "length(feature) / 8.0D AS w"), "given")
    plain = {r["feature"]: r["w"] for r in linear.descend(rows, given, 0.5, 2).collect()}
    with network.training_rows(rows, 0, 1200) as placed:
        assert sorted(r["feature"] for r in placed.hot.collect()) == [E.BIAS, "w:common0", "w:common1", "w:common2"]
        assert placed.rare.count() == 24 and placed.counts.count() == len(plain) == 28
    again = {r["feature"]: r["w"] for r in linear.descend(rows, given, 0.5, 2, 1200).collect()}
    assert again.keys() == plain.keys() and all(math.isclose(again[f], w) for f, w in plain.items())


def test_posts_are_pooled_by_sums_of_fixed_width(prepared):
    table = stage(sequence.random_embedding(vocab.vocabulary(prepared), 16), "vectors")
    pooled = sequence.pool_posts(prepared, table)
    pooled.collect()
    plan = pooled._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan
    with pytest.raises(ValueError):
        sequence.pool_posts(prepared, table.withColumn("vec", F.slice("vec", 1, F.length("term"))))


def test_saved_sequence_model_predicts_the_same(spark, prepared, tmp_path):
    table = stage(sequence.random_embedding(vocab.vocabulary(prepared), 16), "vectors")
    model = sequence.SequenceModel.fit(runs.part(prepared, "train"), table)
    store = StageStore(spark, str(tmp_path))
    model.save(store, data="v1")
    bare = sequence.SequenceModel.load(store, data="v1").predict(prepared.drop("target"))
    assert bare.columns == ["id", "pred"] and bare.count() == 10
    again = sequence.SequenceModel.load(store, data="v1")
    direct = sorted(model.predict(prepared).collect())
    assert sorted(again.predict(prepared).collect()) == direct and len(direct) == 10


@pytest.mark.parametrize("classifier", P.CLASSIFIERS)
def test_saved_model_predicts_the_same(spark, posts, prepared, tmp_path, classifier):
    short = network.Settings(rounds=2)
    experiment = runs.Experiment("NoStem", "TFIDF", classifier, select_on="test", network=short)
    trained = runs.train(prepared, experiment)
    direct = trained.predict(runs.part(prepared, "test"))
    store = StageStore(spark, str(tmp_path))
    trained.save(store, data="v1")
    report = runs.rescore(store, posts, experiment, data="v1").first()
    assert report["tn"] + report["fn"] + report["fp"] + report["tp"] == 4
    kept = store.load_predictions(experiment.model_id).select("id", "pred").collect()
    assert sorted(kept) == sorted(direct.select("id", "pred").collect())
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        runs.rescore(store, posts, experiment, data="v2")


def test_grid_and_options(posts):
    report = runs.run_grid(posts, ("NaiveBayes", "Logistic"), descent.Search(rounds=1), "test")
    runs_done = sorted(r["run_id"] for r in report.collect())
    assert len(runs_done) == 12 and runs_done[0] == "NoStem-Binary-Logistic"
    for wrong in ({"stemming": "x"}, {"weighting": "x"}, {"classifier": "x"}, {"select_on": "x"}):
        with pytest.raises(ValueError):
            runs.Experiment(**wrong)
    assert runs.Experiment(classifier="FFNN").settings().hidden == 20
    assert replace(runs.Experiment(), weighting="TFIDF").run_id == "NoStem-TFIDF-NaiveBayes"


def test_stored_stages_follow_input_settings_and_interrupted_writes(spark, posts, tmp_path):
    store = StageStore(spark, str(tmp_path))
    first = runs.prepare_once(posts, "NoStem", store=store, input_id="a")
    assert runs.prepare_once(posts.limit(3), "NoStem", store=store, input_id="b").count() <= 3
    assert runs.prepare_once(posts.limit(0), "NoStem", store=store, input_id="a").count() == first.count()
    with pytest.raises(ValueError, match="input_id"):
        runs.prepare_once(posts, "NoStem", store=store)
    facts = {"x": 1}
    store.save(spark.range(5), "t", **facts)
    os.remove(f"{store.versions('t', **facts)[-1].folder}/_SUCCESS")
    assert store.reuse("t", lambda: spark.range(7), **facts).count() == 7
    assert store.reuse("t", lambda: spark.range(9), **facts).count() == 7
    one, two = runs.Experiment(), runs.Experiment(legacy_stops=True)
    assert one.model_id != two.model_id and one.run_id == two.run_id
    net = runs.Experiment(classifier="FFNN")
    assert net.model_id != replace(net, network=network.Settings(rounds=3)).model_id
    assert net.model_id != replace(net, select_on="test").model_id


def test_parquet_posts_and_gold_without_order(spark, tmp_path):
    rows = [(1, "a", None, "x", 1), (2, None, "y", "z", 0)]
    df = spark.createDataFrame(rows, src.LABELLED_POST)
    src.write_posts(df, f"{tmp_path}/p", "parquet")
    assert sorted(src.read_posts(spark, f"{tmp_path}/p", fmt="parquet").collect()) == sorted(df.collect())
    gold = [("same text", "Relevant"), ("other", "Relevant"), ("same text!", "Not Relevant")]
    spark.createDataFrame(gold, "text string, choose_one string").coalesce(1).write.option("header", True).csv(f"{tmp_path}/g")
    columns = spark.createDataFrame([], "text string, choose_one string").schema
    read = src.read_gold(spark, f"{tmp_path}/g", columns)
    assert [r["text"] for r in read.orderBy("seq").collect()] == [t for t, _ in gold]
    posts = spark.createDataFrame([(1, "same text"), (2, "other")], "id long, text string")
    assert sorted(map(tuple, labeling.label_match(posts, read).collect())) == [(1, 0), (2, 1)]


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, "a,b", None, 'say "hi"\nsecond line', 1), (2, None, "x", "plain", 0)]
    df = spark.createDataFrame(rows, src.LABELLED_POST)
    src.write_posts(df, f"{tmp_path}/posts")
    assert sorted(src.read_posts(spark, f"{tmp_path}/posts").collect()) == sorted(df.collect())
    both = src.read_splits(spark, f"{tmp_path}/posts", f"{tmp_path}/posts")
    assert {r["split"]: r["n_posts"] for r in src.split_counts(both).collect()} == {"train": 2, "test": 2}
    (tmp_path / "labels.csv").write_bytes(b"id,target\r\n7,1\r\n8,0\r\n")
    labels = src.read_labels(spark, f"{tmp_path}/labels.csv").collect()
    assert [tuple(r) for r in labels] == [(7, 1), (8, 0)]


def test_stage_store(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert store.reuse("n", build, stemming="Stem").count() == 3
    store.reuse("n", build, stemming="NoStem")
    assert len(calls) == 2
    assert fingerprint(a=1, b=2) == fingerprint(b=2, a=1) != fingerprint(a=2, b=1)


def test_stored_tables_come_back(spark, posts, prepared, tmp_path):
    store = StageStore(spark, str(tmp_path))
    train = runs.part(prepared, "train")
    for name, table in {
        "keywords": metadata.keyword_index(runs.part(posts, "train")),
        "vocabulary": vocab.vocabulary_ids(vocab.vocabulary(train)),
        "idf": E.IdfModel.fit(train).table,
    }.items():
        assert sorted(map(str, store.save(table, name, stemming="NoStem").collect())) == sorted(
            map(str, table.collect())
        )
    first = runs.run_experiment(posts, runs.Experiment(), store, input_id="v1").collect()
    nothing = posts.filter(F.lit(False))
    assert runs.run_experiment(nothing, runs.Experiment(), store, input_id="v1").collect() == first


def test_streamed_posts(spark, posts, prepared, tmp_path):
    model = runs.train(prepared, runs.Experiment())
    folder = f"{tmp_path}/in"
    src.write_posts(posts.filter(F.col("split") == "test").drop("split", "target"), folder)
    stream = live.read_post_stream(spark, folder)
    assert live.prepare_stream(stream).isStreaming
    query = live.score_stream(stream, model, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination(60)
    found = spark.read.parquet(f"{tmp_path}/out").select("id", "pred").collect()
    direct = model.predict(runs.part(prepared, "test")).select("id", "pred").collect()
    assert sorted(found) == sorted(direct)


def test_terms_are_counted_once_for_all_passes(posts, monkeypatch):
    counted = []
    count = E.X.term_counts

    def seen(df, *names):
        counted.append(names)
        return count(df, *names)

    monkeypatch.setattr(E.X, "term_counts", seen)
    prepared = runs.prepare_once(posts, "NoStem")
    how = runs.Experiment("NoStem", "Binary", "Logistic", search=descent.Search(rounds=2))
    assert runs.predict_experiment(prepared, how).count() == 4
    assert len(counted) == 1


@pytest.mark.parametrize("weighting", ["Binary", "TFIDF"])
def test_rows_of_the_fitted_posts_need_no_lookup(prepared, weighting):
    train = runs.part(prepared, "train")
    model = E.FeatureBuilder(weighting).fit(train)
    wanted, found = (f(train, keep=("target",)) for f in (model.transform, model.transform_fitted))
    columns = ["id", "target", "feature", "value"]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, wanted.select(columns).collect()))
