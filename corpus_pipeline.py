"""Documents to a training mix: quality, lines, near copies, benchmark passages, weights."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cinderpost.llm import decontaminate as benchmark  # noqa: E402
from cinderpost.llm import lines, mixing, neardup, quality  # noqa: E402
from cinderpost.llm.common import table  # noqa: E402
from cinderpost.session import discard, stage  # noqa: E402


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on this input, accepts.

    Null and empty texts are judged like an empty text, repeated rows alike; without a label 1
    that may be learned from every document stays.
    """
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of runs of lines; a document that loses all its lines goes.

    Null texts, and empty ones, have nothing to lose and stay. n_chars, if there is such a column,
    follows a text that was cut.
    """
    cut = lines.without_repeats(docs)
    left = cut.filter((F.col("n_removed") < F.col("n_lines")) | (F.col("n_lines") == 0))
    if "n_chars" in docs.columns:
        size = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by id and null ids first, of each group of near copies.

    Null and wordless texts are copies of nothing and stay, repeated rows of them too; of other
    repeated rows one stays.
    """
    return neardup.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts have none."""
    return benchmark.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with the words that it takes of each; none is taken 0 times.

    So texts without words go. Repeated rows are taken alike, null sources are one source, and
    columns named size, source_size, target or taken are replaced.
    """
    return mixing.mix(docs).filter("taken > 0")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

# The classifier is trained in rounds, which SQL can't express; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet and read again.

    Empty documents give an empty result with the same columns. Other columns of documents come
    along; names that begin with two underscores are reserved.
    """
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        after = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        discard(docs)
        docs = after
    return docs
