import re

import corpus_pipeline
import test_decontaminate
import test_lines
import test_neardup
from cinderpost.llm import lines, quality
from cinderpost.session import stage
from pyspark.sql import functions as F


def rows_of(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_stages_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    kept = steps["quality_classifier"](spark, docs, tables).cache()
    good = quality.scored(docs, spark.read.parquet(f"{tables}/labels.parquet")).filter("predicted = 1")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in good.collect())
    assert 0 < kept.count() < docs.count()

    cut = steps["line_dedup"](spark, kept, tables).cache()
    left = test_lines.brute(rows_of(kept), lines.MIN_WORDS)
    assert rows_of(cut) == sorted((d, t) for d, (t, n, gone) in left.items() if gone < n)
    assert cut.filter("n_chars != length(text)").count() == kept.filter("n_chars != length(text)").count()

    single = steps["ngram_jaccard_join"](spark, cut, tables).cache()
    classes = test_neardup.brute(rows_of(cut))
    assert [r[0] for r in rows_of(single)] == sorted({c for _, c, _ in classes})

    clean = steps["benchmark_decontamination"](spark, single, tables).cache()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    assert rows_of(clean) == [r for r in rows_of(single) if not test_decontaminate.brute(r[1], items)[1]]

    mixed = steps["source_mixing"](spark, clean, tables)
    for frame in (kept, cut, single, clean):
        assert frame.columns == columns
    assert mixed.columns == [*columns, "size", "source_size", "target", "taken"]
    for r in mixed.collect():
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) and 0 < r["taken"] <= 2 * r["size"]
    for frame in (kept, cut, single, clean):
        frame.unpersist()


def test_empty_documents(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, tables)
    assert docs.count() == 0


def test_odd_documents(spark, tables):
    """Nulls in any column, repeated rows, a very long text, and columns named like results."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    plain = docs.limit(60).withColumns({"score": F.lit("x"), "_key": F.lit(1), "n_hit": F.lit("y"), "class_id": F.lit(2)})
    long = "\n".join(f"line {i} of a very long text with its own words {i * i}" for i in range(8000))
    odd = [
        (None, None, None, None, None), (None, None, None, None, None), (9001, None, "en", "a", 0), (9002, "", "en", None, 0),
        (9003, long, "en", "a", len(long)), (9003, long, "en", "a", len(long)), (9004, "one", None, "b", 3),
    ]
    extra = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in odd], plain.schema)
    frame = plain.unionByName(extra)
    for name, step in corpus_pipeline.STAGES:
        before = frame.count()
        after = stage(step(spark, frame, tables), name)
        assert after.columns[: len(plain.columns)] == plain.columns
        assert 0 < after.count() <= before
        if name != "source_mixing":
            assert after.filter("text IS NULL OR text = ''").count() == frame.filter("text IS NULL OR text = ''").count() or name == "quality_classifier"
        frame = after
    assert frame.filter("text IS NULL OR text = ''").count() == 0
    assert frame.filter("doc_id = 9003").count() <= 1
