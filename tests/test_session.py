"""Where written intermediate tables go."""

from types import SimpleNamespace

import pytest

from cinderpost import session


def fake(master, setting=None, checkpoint=None):
    context = SimpleNamespace(
        master=master, applicationId="app-1", getCheckpointDir=lambda: checkpoint
    )
    settings = {"spark.checkpoint.dir": setting}
    conf = SimpleNamespace(get=settings.get)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_folder():
    assert session.shared_folder(fake("spark://x", "hdfs:///shared/")) == "hdfs:///shared"
    assert session.shared_folder(fake("spark://x", None, "hdfs:///c")) == "hdfs:///c"
    local = session.shared_folder(fake("local[2]"))
    assert local == session.shared_folder(fake("local[2]"))
    with pytest.raises(ValueError):
        session.shared_folder(fake("spark://x"))


def test_stage_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, ["a"], None)], "id long, t array<string>, x double")
    written = session.stage(df, "kept")
    assert written.collect() == df.collect() and written.dtypes == df.dtypes


def test_spread(spark):
    few = spark.range(100).coalesce(1)
    assert session.spread(few, "id").rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(9)
    assert session.spread(many, "id") is many
