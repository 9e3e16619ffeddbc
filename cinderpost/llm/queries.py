"""One query per operator over its whole table, with production settings."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderpost.llm import chat, collocations, decontaminate, hamming, linkgraph, lines, mixing, neardup, quality, secrets, substrings, topk, whitening
from cinderpost.llm.common import table
from cinderpost.llm.oracles import ORACLES  # noqa: F401

Q = {}


def query(fn):
    Q[fn.__name__] = fn
    return fn


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150 % of all words takes from every document."""
    decided, sized = mixing.plan_mix(table(spark, sf_dir, "documents"))
    rows = decided.apply(sized, F.col("_size"), F.col("_h"))
    return rows.select("doc_id", "source", "size", "source_size", "target", "taken")


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by positive-unlabelled learning."""
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest integer products of every hundredth vector with all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.pmod("vec_id", F.lit(100)) == 0)


@query
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose five-word shingles are similar at 0.8 or more."""
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links")


@query
def op5_chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k (chosen) and 2k+1 (rejected) as prompt and masked completions."""
    return chat.format_preferences(chat.neighbour_pairs(table(spark, sf_dir, "conversations")))


def _lines_left(kept: DataFrame) -> DataFrame:
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_removed", "n_runs", digest)


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per document, how many go as later copies, and a digest of what stays."""
    return _lines_left(lines.without_repeats(table(spark, sf_dir, "documents")))


@query
def op6_line_dedup_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, where one word is enough: no later copy of a line stays."""
    return _lines_left(lines.without_repeats(table(spark, sf_dir, "documents"), 1))


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that strings of 200 bytes found elsewhere too take from every document."""
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", digest)


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans that look like secrets, with corpus-wide ownership."""
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share ten words in a row with an item of the benchmark."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find_contamination(docs, items).drop("_key")


URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by the longest fitting rule, else by trust propagated between hosts."""
    return linkgraph.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of every usable vector."""
    return whitening.whitened_table(table(spark, sf_dir, "embeddings"))


@query
def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose five-word shingles are similar at 0.85 or more."""
    return hamming.deduplicated(table(spark, sf_dir, "documents"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 tightest phrases of two or three words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


Q["pipeline"] = corpus_pipeline.run
