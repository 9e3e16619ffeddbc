import random

import pytest

from cinderpost.operators import labeling
from cinderpost.sources import posts as src
from cinderpost.sources import records
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("keyword", "text")]])


def field(value, rng):
    if value is None:
        return ""
    if any(c in value for c in ',"\r\n') or value == "" or rng.random() < 0.2:
        return '"' + value.replace('"', '""') + '"'
    return value


def collection(seed, n=60):
    rng = random.Random(seed)
    pieces = ["word", ",", '"', "\n", "\n\n", '",', '"\n', "é😀", " ", "\r\n", "x" * 40]
    rows = []
    for i in range(n):
        text = "a" + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))) + "z"
        rows.append((i, rng.choice([None, "fire", "a,b"]), text))
    rows.append((n, None, "very " + "long\n" * 400 + "text"))
    rows += [(n + 1 + i, "k", f"last {i}") for i in range(5)]
    return rows, rng


def write(path, rows, rng, end="\n", closing=True):
    lines = ["id,keyword,text", *[",".join([str(i), field(k, rng), field(t, rng)]) for i, k, t in rows]]
    path.write_bytes((end.join(lines) + (end if closing else "")).encode())


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    yield lambda size: (spark.conf.set("spark.sql.files.maxPartitionBytes", size), spark.conf.set("spark.sql.files.openCostInBytes", 1))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def listed(df):
    return sorted(map(str, df.select("id", "keyword", "text").collect()))


@pytest.mark.parametrize("size", [97, 700, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_multi_line_reader(spark, tmp_path, small_splits, size, end):
    for k in range(3):
        rows, rng = collection(k)
        write(tmp_path / f"part-{k}.csv", rows, rng, end, closing=k != 1)
    whole = src.csv_reader(spark.read, SCHEMA).csv(str(tmp_path))
    # That reader makes CRLF inside quotes LF, if that is how the lines end.
    own = F.replace("text", F.lit("\r\n"), F.lit("\n")) if end == "\r\n" else F.col("text")
    expected = listed(whole)
    assert len(expected) == 3 * 66
    small_splits(size)
    out = records.read_csv(spark, str(tmp_path), SCHEMA, places=True)
    assert listed(out.withColumn("text", own)) == expected
    texts = {(k, r["id"]): r["text"] for k in range(3) for r in out.filter(F.col("file").endswith(f"part-{k}.csv")).collect()}
    assert texts == {(k, i): t for k in range(3) for i, _, t in collection(k)[0]}
    if size == 97:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 100
    for k in range(3):  # the places have the order of the rows
        own = out.filter(F.col("file").endswith(f"part-{k}.csv")).orderBy(*records.PLACE).collect()
        assert [r["id"] for r in own] == list(range(66))


def test_odd_files(spark, tmp_path, small_splits):
    small_splits(16)
    texts = {
        "a": "id,keyword,text\n",
        "b": "",
        "c": 'id,keyword,text\n1,,"never closed\n2,x,y',
        "d": '"id","key\nword","text"\n\n3,,"a"\n\n\n4,k,""\n',
        "e": "id,keyword,text\n5,k\n6,,t",
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
        expected = sorted(map(str, src.csv_reader(spark.read, SCHEMA).csv(str(tmp_path / f"{name}.csv")).collect()))
        assert sorted(map(str, records.read_csv(spark, str(tmp_path / f"{name}.csv"), SCHEMA).collect())) == expected, name
    assert records.read_csv(spark, str(tmp_path / "e.csv"), SCHEMA, header=False).count() == 3


def test_changed_splits_are_an_error(spark, tmp_path, small_splits):
    rows, rng = collection(5)
    write(tmp_path / "x.csv", rows, rng)
    small_splits(200)
    out = records.read_csv(spark, str(tmp_path), SCHEMA)
    small_splits(333)
    with pytest.raises(Exception, match="changed while they were read"):
        out.withColumn("again", F.lit(1)).collect()


GOLD = T.StructType([T.StructField(c, T.StringType()) for c in ("text", "choose_one")])


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_last_gold_row_wins_however_files_are_cut(spark, tmp_path, small_splits, fmt):
    rng = random.Random(3)
    rows = [(f"text {rng.randrange(12)}", rng.choice(["Relevant", "Not Relevant", "Can't Decide"])) for _ in range(400)]
    last = {t.replace(" ", ""): int(c == "Relevant") for t, c in rows if c != "Can't Decide"}
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, text string, choose_one string")
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    ordered = frame.coalesce(1).sortWithinPartitions("i").drop("i")
    src.write_posts(ordered, one, fmt)
    src.write_posts(frame.repartitionByRange(7, "i").sortWithinPartitions("i").drop("i"), many, fmt)
    posts = spark.createDataFrame([(k, t) for k, t in enumerate(last)], "id long, text string")
    small_splits(150)
    for path in (one, many):
        gold = src.read_gold(spark, path, GOLD, fmt)
        found = {r["id"]: r["target"] for r in labeling.label_match(posts, gold).collect()}
        assert [found[k] for k in range(len(last))] == list(last.values())


def test_written_posts_come_back(spark, tmp_path):
    rows = [(1, None, " lead", 'a "q", b\nline\r\nend ', 1), (2, "k", None, "x", 0), (3, "a", "x", None, None)]
    df = spark.createDataFrame(rows, src.LABELLED_POST)
    src.write_posts(df, str(tmp_path / "posts"))
    assert sorted(map(tuple, src.read_posts(spark, str(tmp_path / "posts")).collect())) == rows
