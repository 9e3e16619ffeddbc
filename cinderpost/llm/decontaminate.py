"""Benchmark decontamination by winnowing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderpost.llm.common import LOWER, UPPER, joined, row_key
from cinderpost.session import stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 5
WINDOW = 10


def words(text: str = "text") -> Column:
    """Lower-cased (A-Z) runs of letters, digits and signs beyond ASCII; null has none."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def fingerprint(hashes: Column, start: Column, length: int, gram: int = GRAM) -> Column:
    """Smallest hash among the k-grams of the window of ``length`` words from ``start``."""
    k = min(gram, length)
    grams = [
        F.xxhash64(*[F.get(hashes, start + (i + j)) for j in range(k)])
        for i in range(length - k + 1)
    ]
    return F.least(*grams) if len(grams) > 1 else grams[0]


def _hashes(column: str) -> Column:
    return F.transform(column, lambda w: F.xxhash64(w))


def _text_of(start: Column, length: Column) -> Column:
    return F.array_join(F.slice("_words", start + 1, length), " ")


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every window of every item: item_id (as string), _len, window (its words)."""
    n = F.size("_words")
    return (
        items.select(F.col("item_id").cast("string").alias("item_id"), words().alias("_words"))
        .filter(n > 0)
        .withColumn("_len", F.least(n, F.lit(window)))
        .withColumn("_at", F.explode_outer(F.sequence(F.lit(0), F.size("_words") - F.col("_len"))))
        .select("item_id", "_len", _text_of(F.col("_at"), F.col("_len")).alias("window"))
        .distinct()
    )


def find_contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated, and _key.

    Winnowing: of every window of ten words only the smallest 5-gram hash is looked up among
    the smallest hashes of the items' windows. Equal windows have equal smallest hashes, so
    every shared span of ten words is found. A hit is extended to its whole window, whose
    words must equal an item's; overlapping windows join to longer spans.

    Fingerprints of the items are broadcast only if measured small; beyond that places are
    shuffled as narrow rows of key, position and fingerprint, never with their text. Only
    documents with a fingerprint that was found are read a second time, for the words there.

    An item of fewer words is one window of that length; items and documents without words
    have none. Equal rows and equal ids count once in n_items; items without an id count for
    hits but not in n_items. Extra columns are ignored.
    """
    listed = stage(item_windows(items, window), "windows")
    lengths = [r[0] for r in listed.select("_len").distinct().orderBy("_len").collect()]
    lengths = lengths or [window]
    marks = listed.select("window", "_len").distinct().withColumn("_words", F.split("window", " "))
    marks = marks.withColumn("_h", _hashes("_words"))
    mark = F.coalesce(
        *[F.when(F.col("_len") == n, fingerprint(F.col("_h"), F.lit(0), n, gram)) for n in lengths]
    )
    found = F.struct("_len", mark.alias("fp"))
    prints = stage(marks.select(found.alias("_print"), F.lit(True).alias("_found")).distinct(), "prints")

    def looked_up(n: int) -> Column:
        inside = (F.col("_at") >= 0) & (F.col("_at") + n <= F.col("n_words"))
        return F.when(
            inside,
            F.struct(F.lit(n).alias("_len"), fingerprint(F.col("_h"), F.col("_at"), n, gram).alias("fp")),
        )

    # Position -1 stands for the document itself, so that one pass over the texts gives both.
    places = (
        docs.select("doc_id", row_key().alias("_key"), words().alias("_words"))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("_h", _hashes("_words"))
        .withColumn("_at", F.explode_outer(F.sequence(F.lit(-1), F.size("_words") - 1)))
    )
    narrow = ("doc_id", "_key", "n_words", "_at")
    if len(lengths) == 1:
        places = places.select(*narrow, looked_up(lengths[0]).alias("_print"))
    else:
        several = F.filter(F.array(*map(looked_up, lengths)), lambda p: p.isNotNull())
        places = places.select(*narrow, F.explode_outer(several).alias("_print"))
    hits = joined(places, prints, "_print").filter((F.col("_at") < 0) | F.col("_found"))
    marked = stage(hits.select(*narrow, F.col("_print._len").alias("_len")), "marked")
    spots = stage(
        marked.filter(F.col("_at") >= 0).groupBy("_key").agg(F.collect_set(F.struct("_at", "_len")).alias("_spots")), "spots"
    )
    window_of = lambda s: F.struct(s["_at"], s["_len"], _text_of(s["_at"], s["_len"]).alias("window"))
    spans = (
        joined(docs.select(row_key().alias("_key"), "text"), spots, "_key", "inner")
        .select("_key", "_spots", words().alias("_words"))
        # The second use of the words keeps Catalyst from reading the text anew for every place.
        .select("_key", F.size("_words").alias("_n"), F.transform("_spots", window_of).alias("_found"))
        .select("_key", "_n", F.explode_outer("_found").alias("_s"))
        .select("_key", F.when(F.col("_s._at") < F.col("_n"), F.col("_s._at")).alias("_at"), "_s._len", "_s.window")
        .distinct()
    )
    true_spans = joined(spans, stage(listed.select("window").distinct(), "window-texts"), "window", "left_semi")
    true_spans = stage(true_spans, "spans")
    covered = true_spans.groupBy("_key").agg(
        F.array_sort(F.collect_list(F.struct("_at", (F.col("_at") + F.col("_len")).alias("to")))).alias("_s")
    ).select(
        "_key",
        F.aggregate(
            "_s",
            F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n")),
            lambda acc, s: F.struct(
                F.greatest(acc["to"], s["to"]).alias("to"),
                (acc["n"] + F.greatest(s["to"] - F.greatest(acc["to"], s["_at"]), F.lit(0))).alias("n"),
            ),
            lambda acc: acc["n"],
        ).alias("n_hit"),
    )
    pairs = joined(true_spans.select("_key", "window").distinct(), listed.select("window", "item_id"), "window", "inner")
    named = pairs.groupBy("_key").agg(F.collect_set("item_id").alias("_items"))
    own = marked.filter(F.col("_at") < 0).select("doc_id", "_key", "n_words")
    items_of = F.coalesce("_items", F.array().cast("array<string>"))
    return (
        own.join(covered, "_key", "left")
        .join(named, "_key", "left")
        .select(
            "doc_id",
            "_key",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(items_of).cast("long").alias("n_items"),
            F.sha2(F.array_join(F.array_sort(items_of), ","), 256).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )


def decontaminated(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The documents that share no window with any item, as they are.

    Names of columns that begin with two underscores are reserved.
    """
    found = find_contamination(docs, items, **settings)
    bad = stage(found.filter("contaminated").select(F.col("_key").alias("__key")).distinct(), "contaminated")
    rows = docs.withColumn("__key", row_key())
    return joined(rows, bad, "__key", "left_anti").drop("__key")
