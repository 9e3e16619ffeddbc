import json
import os

import pytest

from cinderpost.sources.stages import StageStore


def numbers(df):
    return sorted(r[0] for r in df.collect())


def test_readers_keep_their_version(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    first = store.save(spark.range(3), "t", x=1)
    again = store.load("t", x=1)
    store.save(spark.range(5), "t", x=1)
    assert numbers(first) == numbers(again) == [0, 1, 2]
    assert numbers(store.load("t", x=1)) == list(range(5))
    assert numbers(store.load("t", version=1, x=1)) == [0, 1, 2]
    assert [v.number for v in store.versions("t", x=1)] == [1, 2]
    with pytest.raises(FileNotFoundError):
        store.load("t", version=3, x=1)
    with pytest.raises(FileNotFoundError):
        store.load("t", x=2)


def test_interrupted_writes_are_absent(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    folder = store.path("t", x=1)
    spark.range(9).write.parquet(f"{folder}/data-lost")  # written, never published
    assert not store.complete("t", x=1)
    os.makedirs(f"{folder}/_versions")
    for number, text in (("00000001", ""), ("00000002", '{"name": "t", "da'), ("00000004", json.dumps({"name": "t", "facts": {}, "data": "data-gone", "written": 0.0}))):
        with open(f"{folder}/_versions/{number}", "w") as out:
            out.write(text)
    assert not store.complete("t", x=1)
    assert numbers(store.reuse("t", lambda: spark.range(2), x=1)) == [0, 1]
    assert [v.number for v in store.versions("t", x=1)] == [5]


def test_writers_at_the_same_time_get_numbers_of_their_own(spark, tmp_path, monkeypatch):
    one, two = StageStore(spark, str(tmp_path)), StageStore(spark, str(tmp_path))
    create, met = one._create, []

    def slow(path, text):
        if not met:  # another writer publishes between the look and the claim
            met.append(two.save(spark.range(7), "t"))
        return create(path, text)

    monkeypatch.setattr(one, "_create", slow)
    assert numbers(one.save(spark.range(4), "t")) == list(range(4))
    assert [v.number for v in one.versions("t")] == [1, 2]
    assert numbers(two.load("t")) == list(range(4)) and numbers(met[0]) == list(range(7))


def test_expired_versions_and_lost_data_go(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    for n in (2, 3, 4):
        store.save(spark.range(n), "t", x=1)
    store.save(spark.range(8), "u")
    spark.range(9).write.parquet(f"{store.path('t', x=1)}/data-lost")
    assert store.expire() == 0 and len(store.versions("t", x=1)) == 3
    assert store.expire(grace=0) == 3
    assert [v.number for v in store.versions("t", x=1)] == [3]
    assert numbers(store.load("t", x=1)) == [0, 1, 2, 3] and numbers(store.load("u")) == list(range(8))
    store.save(spark.range(1), "t", x=1)
    assert [v.number for v in store.versions("t", x=1)] == [3, 4]


def test_catalogue_and_predictions(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        store.load_predictions()
    for model in ("a", "b", "a"):
        store.save_predictions(spark.range(2).withColumnRenamed("id", "pred"), model)
    store.save(spark.range(1), "vocabulary", stemming="Stem")
    listed = {(v.name, json.dumps(v.facts), v.number) for v in store.catalogue()}
    assert listed == {
        ("predictions", '{"model": "a"}', 2), ("predictions", '{"model": "b"}', 1), ("vocabulary", '{"stemming": "Stem"}', 1),
    }
    assert store.load_predictions().groupBy("model").count().count() == 2
    assert store.load_predictions().count() == 4 and store.load_predictions("b").count() == 2
