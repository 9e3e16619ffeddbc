"""Vocabularies, features, lookups, ranking, history, batches, evaluation, label recovery."""

import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cinderpost.operators import batches, evaluate, history, labeling, metadata, vocab
from cinderpost.operators import features as E
from cinderpost.operators import lookup
from cinderpost.operators import tokens as K
from cinderpost.operators.ranking import dense_index, rank_within
from cinderpost.plans import queries
from cinderpost.session import stage


@pytest.fixture(scope="module")
def prepared(posts):
    return stage(K.prepare(posts), "test-prepared")


def train(df):
    return df.filter(F.col("split") == "train")


def test_metadata(posts):
    rows = {r["id"]: r for r in metadata.url_count(metadata.location_flag(posts)).collect()}
    assert [rows[i]["url"] for i in (1, 4, 5, 10)] == [1, 2, 0, 0]
    assert [rows[i]["loc"] for i in (1, 2)] == [1, 0]


def test_keywords(posts):
    index = metadata.keyword_index(train(posts))
    assert {r["keyword"]: r["keywd"] for r in index.collect()} == {None: 0, "fire": 1, "flood": 2}
    coded = {r["id"]: r["keywd"] for r in metadata.keyword_encode(posts, index).collect()}
    assert (coded[8], coded[3], coded[7]) == (metadata.UNKNOWN, 0, 2)
    with pytest.raises(Exception, match="unseen keyword: quake"):
        metadata.keyword_encode(posts, index, unseen="error").collect()


def test_sequences(prepared):
    words = vocab.joint_vocabulary(prepared)
    ids = {r["term"]: r["term_id"] for r in words.collect()}
    assert sorted(ids.values()) == list(range(len(ids))) and ids["<pad>"] == len(ids) - 1
    longest = K.max_length(prepared).first()["max_len"]
    ragged = vocab.pad_sequences(vocab.encode_sequences(prepared, words), longest, ids["<pad>"])
    tokens = {r["id"]: r["tokens"] for r in prepared.collect()}
    for r in ragged.collect():
        assert r["ids"] == [ids[t] for t in tokens[r["id"]]]
        assert (r["max_len"], r["pad_id"]) == (longest, ids["<pad>"])
    full = ragged.select("id", vocab.padded(F.col("ids"), F.col("max_len"), F.col("pad_id")).alias("ids"))
    coded = {r["id"]: r["ids"] for r in full.collect()}
    for post, row in coded.items():
        assert row == [ids[t] for t in tokens[post]] + [ids["<pad>"]] * (longest - len(tokens[post]))
    assert set(coded) == set(range(1, 11))


def test_padded_lists_are_as_long_as_the_longest(spark):
    coded = spark.createDataFrame([(1, [3, 1]), (2, []), (3, [0, 2, 1])], "id int, ids array<long>")
    found = {r["id"]: r["padded"] for r in vocab.pad_sequences(coded, 3, 9).collect()}
    assert found == {1: [3, 1, 9], 2: [9, 9, 9], 3: [0, 2, 1]}


def test_encoded_posts_are_filled_up(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    rows = queries.sequence_encode(spark, folder).collect()
    assert rows and all(len(r["ids"].split(",")) == r["max_len"] for r in rows)
    assert any(r["ids"].endswith(f",{r['pad_id']},{r['pad_id']}") for r in rows)


def test_known_and_unknown_terms_part_the_counts(prepared):
    marked = vocab.split_by_vocabulary(prepared, vocab.vocabulary(train(prepared))).collect()
    assert len(marked) == E.term_frequency(prepared).count()
    assert {r["term"] for r in marked if not r["known"]} == {"tears", "earthquake", "reported"}


def test_term_counts_equal_a_counter(spark):
    draw = random.Random(1)
    lists = [[draw.choice("abcde") for _ in range(draw.randrange(0, 9))] for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(lists)), "id int, tokens array<string>")
    found = {(r["id"], r["term"]): r["tf"] for r in E.term_frequency(df).collect()}
    assert found == {(i, t): n for i, row in enumerate(lists) for t, n in Counter(row).items()}


def test_idf_applies_to_other_posts(prepared):
    model = E.IdfModel.fit(train(prepared))
    found = {(r["id"], r["term"]): r["tfidf"] for r in model.transform(prepared).collect()}
    assert found[2, "fire"] == pytest.approx((1 + math.log10(2)) * math.log10(6 / 3))
    assert found[8, "fire"] == pytest.approx(math.log10(6 / 3))
    assert (8, "earthquake") not in found


def test_features(prepared):
    model = E.FeatureBuilder("Binary").fit(train(prepared))
    rows = {(r["id"], r["feature"]): r["value"] for r in model.transform(prepared).collect()}
    assert rows[4, "url"] == 2.0 and rows[2, "w:fire"] == 1.0 and rows[1, "loc"] == 1.0
    assert rows[3, "kw"] == 1.0 and (8, "kw:quake") not in rows and (2, "loc") not in rows
    assert all((i, E.BIAS) in rows for i in range(1, 11))
    size = model.dims().first()
    assert size["dims"] == size["n_terms"] + size["n_keywords"] + 2 and size["n_keywords"] == 3
    with pytest.raises(ValueError):
        E.FeatureBuilder("binary")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("support", [None, "df"])
def test_skewed_lookup_equals_a_plain_join(spark, how, support, monkeypatch):
    monkeypatch.setattr(lookup, "HOT_KEYS", 6)
    draw = random.Random(2)
    keys = ["hot"] * 400 + ["gone"] * 200 + [None] * 250 + [f"k{draw.randrange(60)}" for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(keys)), "id int, key string")
    table = spark.createDataFrame(
        [("hot", 1.5, 400)] + [(f"k{i}", float(i), 5) for i in range(40)],
        "key string, w double, df long",
    )
    wanted = rows.join(table.drop("df") if support else table, "key", how)
    found = lookup.keyed_lookup(rows, table, "key", how, support=support, broadcast_bytes=0)
    columns = sorted(wanted.columns)
    assert sorted(map(str, found.select(columns).collect())) == sorted(
        map(str, wanted.select(columns).collect())
    )
    assert {r["key"] for r in lookup.hot_keys(rows, "key").collect()} == {"hot", "gone"}


def test_rows_without_a_key_are_not_shuffled_by_it(spark):
    rows = spark.createDataFrame([(i, None) for i in range(100)] + [(100, "a")], "id int, key string")
    table = spark.createDataFrame([("a", 1.5)], "key string, w double")
    found = lookup.keyed_lookup(rows, table, "key", broadcast_bytes=0)
    assert found.count() == 101 and found.filter("w IS NOT NULL").count() == 1
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(key" in plan and "isnull(key" in plan


@pytest.mark.parametrize("support", [None, "df"])
def test_frequent_entries_stay_with_their_rows_as_far_as_the_size_allows(spark, support, monkeypatch):
    monkeypatch.setattr(lookup, "HOT_KEYS", 4)
    keys = [f"k{n:02d}" for n in range(40) for _ in range(40 - n)]
    rows = stage(spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, key string"), "rows")
    entries = [(f"k{n:02d}", n, 40 - n) for n in range(40)]
    table = stage(spark.createDataFrame(entries, "key string, x int, df int"), "table")
    hot, staged = [], lookup.stage

    def seen(df, name, *more):
        out = staged(df, name, *more)
        if name == "hot-keys":
            hot.extend(r["key"] for r in out.collect())
        return out

    monkeypatch.setattr(lookup, "stage", seen)
    # No key holds a quarter of the rows; eighteen entries of 91 bytes fit half of the size.
    found = lookup.keyed_lookup(rows, table, "key", "inner", support=support, broadcast_bytes=2 * 18 * 91)
    assert 10 <= len(hot) <= 18 and sorted(hot) == [f"k{n:02d}" for n in range(len(hot))]
    assert sorted((r["id"], r["x"]) for r in found.collect()) == [(i, int(k[1:])) for i, k in enumerate(keys)]


def test_measured_bytes_counts_what_is_nested(spark):
    size = lambda schema, value: lookup.measured_bytes(spark.createDataFrame([(value,)], schema))
    assert size("x string", None) < size("x string", "a" * 100) - 90
    assert size("x binary", bytearray(b"a" * 1000)) > 1000
    assert size("x array<bigint>", [1] * 100) > 800
    assert size("x array<string>", ["a" * 100] * 10) > 1000
    assert size("x struct<a:int,b:struct<c:string,d:array<binary>>>", (1, ("c" * 50, [bytearray(500)] * 3))) > 1550
    assert size("x map<string,array<string>>", {"k" * 100: ["v" * 200] * 2}) > 500
    assert size("x array<struct<a:int,b:int,c:string>>", [(1, 2, "c" * 40)] * 20) > 20 * 56
    assert size("x array<struct<a:string>>", None) < 100
    assert lookup.measured_bytes(spark.createDataFrame([], "x string")) == 0


def test_dense_index(spark):
    keys = [None, *[f"w{i:04d}" for i in range(500)]]
    shuffled = keys[:]
    random.Random(4).shuffle(shuffled)
    df = spark.createDataFrame([(k,) for k in shuffled], "k string").repartition(7)
    found = {r["k"]: r["n"] for r in dense_index(df, "k", "n").collect()}
    assert found == {k: i for i, k in enumerate(keys)}


def test_rank_within_buckets(spark):
    rows = [(g, t, t // 10) for g in (1, 2) for t in range(0, 95, g)]
    df = spark.createDataFrame(rows, "g int, t int, b int")
    found = {(r["g"], r["t"]): r["n"] for r in rank_within(df, "g", "b", ["t"], "n").collect()}
    assert found == {(g, t): i + 1 for g in (1, 2) for i, t in enumerate(range(0, 95, g))}


def test_rank_within_keeps_rows_without_group_or_bucket(spark):
    rows = [(1, 5, 0), (1, None, None), (None, 3, 0), (None, 4, 0)]
    df = spark.createDataFrame(rows, "g int, t int, b int")
    found = {(r["g"], r["t"]): r["n"] for r in rank_within(df, "g", "b", ["t"], "n").collect()}
    assert found == {(1, None): 1, (1, 5): 2, (None, 3): 1, (None, 4): 2}


def curve(spark, values, run="r"):
    rows = [(run, i + 1, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "run_id string, epoch int, test_acc double")


def test_stop_and_checkpoint(spark):
    assert history.early_stop(curve(spark, [50, 60, 55, 49]), 4).first()["stop_epoch"] == 4
    assert history.best_checkpoint(curve(spark, [50, 60, 60])).first()["epoch"] == 2
    assert history.early_stop(curve(spark, [1, 2, 3, 4, 5]), 3).first()["stop_epoch"] is None
    assert history.best_checkpoint(curve(spark, [0, 0])).count() == 0
    with pytest.raises(ValueError):
        history.early_stop(curve(spark, [1]), 1)


def test_stop_across_blocks(spark):
    draw = random.Random(6)
    for length in (1023, 1024, 1026, 2100):
        values = [1.0 + i + draw.random() for i in range(length)]
        values[-1] = values[-4]
        stop = history.early_stop(curve(spark, values), 3).first()["stop_epoch"]
        assert stop == length


def test_batches(spark):
    df = spark.range(1000).withColumnRenamed("id", "id")
    sizes = {r["batch"]: r["count"] for r in batches.minibatches(df).groupBy("batch").count().collect()}
    assert sizes == {0: 256, 1: 256, 2: 256, 3: 232}
    mixed = batches.shuffled_minibatches(df, seed=1)
    assert sorted(r["count"] for r in mixed.groupBy("batch").count().collect()) == [232, 256, 256, 256]
    order = [r["id"] for r in batches.shuffled(df, 1).collect()]
    assert sorted(order) == list(range(1000)) and order != list(range(1000))


def test_evaluation(spark):
    df = spark.createDataFrame(
        [("a", p, t) for p, t in [(0, 0), (0, 1), (1, 0), (1, 1), (1, 1)]],
        "run_id string, pred int, target int",
    )
    row = evaluate.eval_report(df).first()
    assert (row["tn"], row["fn"], row["fp"], row["tp"], row["accuracy"]) == (1, 1, 1, 2, 0.6)
    assert evaluate.accuracy(df).first()["accuracy"] == pytest.approx(0.6)
    cells = {r["pred"]: (r["actual0"], r["actual1"]) for r in evaluate.confusion_matrix(df).collect()}
    assert cells == {0: (1, 1), 1: (1, 2)}
    bad = df.withColumn("target", F.lit(-1))
    with pytest.raises(Exception, match="target outside 0/1"):
        evaluate.eval_report(bad).collect()


def test_labels_recovered(spark):
    posts = spark.createDataFrame(
        [(1, "Big fire!"), (2, "nothing"), (3, "!!!"), (4, "both"), (5, "unsure")],
        "id long, text string",
    )
    gold = spark.createDataFrame(
        [
            (1, "big-fire", "Relevant"), (2, "* Big fire", "Relevant"), (3, "???", "Not Relevant"),
            (4, "both", "Relevant"), (5, "bo th", "Not Relevant"), (6, "both", "Can't Decide"),
            (7, "unsure", "Can't Decide"),
        ],
        "seq long, text string, choose_one string",
    )
    found = {r["id"]: r["target"] for r in labeling.label_match(posts, gold).collect()}
    assert found == {1: 1, 2: -1, 3: 0, 4: 0, 5: -1}
    dropped = labeling.label_match(posts, gold, drop_empty=True)
    assert {r["id"]: r["target"] for r in dropped.collect()}[3] == -1
    assert sorted(r["id"] for r in labeling.unmatched(posts, gold).collect()) == [2, 5]
    conflict = labeling.label_conflicts(gold).collect()
    assert [(r["n_zero"], r["n_one"]) for r in conflict] == [(1, 1)]
    assert labeling.add_labels(posts, labeling.label_match(posts, gold)).columns == ["id", "text", "target"]


def test_encoded_lists_shuffle_one_number_a_token(spark):
    posts = spark.createDataFrame([(1, ["b", "a", "x", "b"]), (2, []), (3, ["x"])], "id long, tokens array<string>")
    for wide in (0, -5, vocab.WIDE):
        words = spark.createDataFrame([("a", wide), ("b", wide + 1)], "term string, term_id long")
        found = vocab.encode_sequences(posts, words)
        assert {r["id"]: r["ids"] for r in found.collect()} == {1: [wide + 1, wide, wide + 1], 2: [], 3: []}
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert ("struct(pos" in plan) == (wide != 0)
