"""Line dedup: repeated runs of lines by suffix ranks over line numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderpost.llm.common import joined, row_key
from cinderpost.operators.lookup import keyed_lookup
from cinderpost.operators.ranking import dense_index
from cinderpost.session import discard, stage

# One or two words recur by chance; a run of lines with more is a copy wherever it comes again.
MIN_WORDS = 3
# A sign between words, and any other.
GAP, SIGN = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def _place() -> Column:
    return F.struct("doc_id", "_key", "_i")


def _words(line: Column, most: int) -> Column:
    """Words of a line that has any, counted up to ``most``; no line is read beyond them."""
    found = F.lit(1)
    for n in range(2, most + 1):
        found = F.when(line.rlike(rf"^{GAP}*+(?:{SIGN}++{GAP}++){{{n - 1}}}{SIGN}"), n).otherwise(found)
    return found


def _lines(docs: DataFrame, most: int) -> DataFrame:
    """Lines with words: document, place among them (_i) and in the text (_pos), words, line id.

    The key reads the whole text, so it is made before the lines are unrolled, not for each line.
    Only lines without words are dropped inside the row; the rest is computed line by line, in
    compiled code, with patterns that are compiled once.
    """
    texts = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("pos"), x.alias("line")))
    filled = F.filter(texts, lambda s: s["line"].rlike(SIGN))
    return (
        docs.select("doc_id", "text", row_key().alias("_key"))
        .select("doc_id", "_key", F.posexplode_outer(filled).alias("_i", "_l"))
        .filter(F.col("_l").isNotNull())
        .select(
            "doc_id",
            "_key",
            "_i",
            F.col("_l.pos").alias("_pos"),
            _words(F.col("_l.line"), most).alias("_w"),
            F.struct(F.xxhash64("_l.line").alias("a"), F.hash("_l.line").alias("b")).alias("_name"),
        )
    )


def _ranks(places: DataFrame) -> DataFrame:
    """Names that stand at two places or more, ranked in their order: _name, _rank."""
    repeated = (
        places.filter("_name IS NOT NULL")
        .groupBy("_name")
        .agg(F.min(_place()).alias("lo"), F.max(_place()).alias("hi"))
        .filter("lo != hi")
    )
    ranked = dense_index(repeated.select("_name"), "_name", "_rank")
    return stage(ranked, "line-ranks")


def _suffix_ranks(places: DataFrame, levels: int) -> DataFrame:
    """Prefix doubling: column _r{k} ranks the 2^k lines from a place among all such runs.

    Only places whose first line is repeated are kept. A round pairs the ranks of a place and
    of the place 2^k lines on, sorts the pairs that occur at two places or more in ranges, and
    their order gives the next ranks; runs that occur once have none and drop out.
    """
    first = _ranks(places)
    rows = stage(
        keyed_lookup(places, first, "_name", "inner")
        .select("doc_id", "_key", "_i", "_pos", "_w", F.col("_rank").alias("_r0"))
        .dropDuplicates(["_key", "_i"]),
        "suffixes",
    )
    discard(first)
    order = Window.partitionBy("_key").orderBy("_i")
    for k in range(1, levels):
        step = 1 << (k - 1)
        beside = F.lead("_i", step).over(order) == F.col("_i") + step
        name = F.struct(F.col(f"_r{k - 1}").alias("a"), F.lead(f"_r{k - 1}", step).over(order).alias("b"))
        pairs = stage(
            rows.withColumn("_name", F.when(beside, name)).withColumn(
                "_name", F.when(F.col("_name.a").isNotNull() & F.col("_name.b").isNotNull(), F.col("_name"))
            ),
            "suffix-pairs",
        )
        discard(rows)
        ranks = _ranks(pairs)
        rows = stage(
            keyed_lookup(pairs, ranks, "_name", "left").drop("_name").withColumnRenamed("_rank", f"_r{k}"),
            "suffixes",
        )
        discard(pairs, ranks)
    return rows


def _shortest_run(least: int, levels: int, ends: bool) -> Column:
    """The shortest run of lines that begins (or ``ends``) here and holds ``least`` words.

    A struct of its first line, its stretch of the text and its name; null if the lines beside
    have too few words or are not repeated.
    """
    order = Window.partitionBy("_key").orderBy("_i")

    def at(name: str, offset: int) -> Column:
        """A column of the row that is ``offset`` rows further on."""
        return F.col(name) if not offset else F.lead(name, offset).over(order)

    run, words, whole = F.lit(None), F.lit(0), F.lit(True)
    for n in range(1, least + 1):
        step = (1 - n) if ends else (n - 1)
        whole = whole & (at("_i", step) == F.col("_i") + step)
        before, words = words, words + at("_w", step)
        first, last = (step, 0) if ends else (0, step)
        level = min(n.bit_length(), levels) - 1
        name = F.struct(
            F.lit(n).alias("n"),
            at(f"_r{level}", first).alias("a"),
            at(f"_r{level}", last + 1 - (1 << level)).alias("b"),
        )
        found = F.struct(
            at("_i", first).alias("_i"), at("_pos", first).alias("_from"), at("_pos", last).alias("_to"), name.alias("_name")
        )
        fits = whole & (before < least) & (words >= least)
        run = F.when(fits, found) if n == 1 else run.when(fits, found)
    return run


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Line numbers to delete, one row per document that loses any: _key, _cuts.

    ``_cuts`` holds disjoint stretches (lo, hi), both from 0 and inclusive, in order.

    A run of consecutive lines with ``min_words`` words or more that also begins at an earlier
    place of the corpus (order: doc_id, nulls first, then line) is a later copy. Every line that
    lies in such a run goes, so copies go in their maximal length, shorter lines at their ends
    included; the first copy stays. Lines without words take no part; they go where the lines with
    words on both sides go.

    It is enough to look at shortest runs: those that begin at a line and those that end at a
    line. Any longer run is their union, so prefix doubling ends where no shortest run is longer,
    at ``min_words`` lines of one word each. A run of n lines is named by the suffix ranks of its
    first and of its last 2^k lines, 2^k <= n; the suffixes that share the name are an interval of
    common prefix n or more in suffix order. The smallest place of the interval is the original.

    The lines of one document meet in a window; a common line or run, whatever part of the
    corpus it has, is only counted by aggregates and joined to a measured table.
    """
    levels = max(1, min_words.bit_length())
    places = stage(_lines(docs, min_words), "lines")
    rows = _suffix_ranks(places, levels)
    discard(places)
    runs = stage(
        rows.select(
            "doc_id",
            "_key",
            F.array(_shortest_run(min_words, levels, False), _shortest_run(min_words, levels, True)).alias("_runs"),
        )
        .select("doc_id", "_key", F.explode_outer("_runs").alias("_run"))
        .filter(F.col("_run._name.a").isNotNull() & F.col("_run._name.b").isNotNull())
        .select("doc_id", "_key", "_run._i", "_run._from", "_run._to", "_run._name"),
        "line-runs",
    )
    discard(rows)
    originals = stage(
        runs.groupBy("_name")
        .agg(F.min(_place()).alias("_first"), F.max(_place()).alias("_last"))
        .filter("_first != _last")
        .select("_name", "_first"),
        "line-originals",
    )
    copies = keyed_lookup(runs, originals, "_name", "inner").filter(_place() > F.col("_first"))
    span = F.struct(
        F.col("_i").alias("i"),
        (F.col("_i") + F.col("_name.n") - 1).alias("j"),
        F.col("_from").alias("lo"),
        F.col("_to").alias("hi"),
    )
    spans = F.array_sort(F.collect_set(span))
    cuts = stage(copies.groupBy("_key").agg(_merged(spans).alias("_cuts")), "line-cuts")
    discard(runs, originals)
    return cuts


def _merged(spans: Column) -> Column:
    """Sorted runs as stretches of lines; runs that follow each other are one stretch."""
    kind = "struct<i:int,j:int,lo:int,hi:int>"
    parts = ("i", "j", "lo", "hi")

    def add(acc, s):
        last = acc["open"]
        joins = last.isNotNull() & (s["i"] <= last["j"] + 1)
        wider = F.struct(
            last["i"].alias("i"),
            F.greatest(last["j"], s["j"]).alias("j"),
            last["lo"].alias("lo"),
            F.greatest(last["hi"], s["hi"]).alias("hi"),
        )
        done = F.when(last.isNull() | joins, acc["done"]).otherwise(F.concat(acc["done"], F.array(last)))
        fresh = F.struct(*[s[p].alias(p) for p in parts])
        return F.struct(done.alias("done"), F.when(joins, wider).otherwise(fresh).alias("open"))

    start = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.lit(None).cast(kind).alias("open"))
    return F.aggregate(
        spans,
        start,
        add,
        lambda acc: F.transform(
            F.concat(acc["done"], F.array(acc["open"])),
            lambda s: F.struct(s["lo"].alias("lo"), s["hi"].alias("hi")),
        ),
    )


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents, columns as they are, with n_lines, n_removed, n_runs; text loses the copies.

    A null text has no lines and stays null; an empty one has one empty line. A document that
    loses every line keeps an empty text and has n_removed = n_lines. Rows with the same id and
    text are one document. Columns named like the three counts are replaced;
    names that begin with two underscores are reserved.
    """
    cuts = repeated_lines(docs, min_words).withColumnsRenamed({"_key": "__key", "_cuts": "__cuts"})
    counts = ["n_lines", "n_removed", "n_runs"]
    kept = [c for c in docs.columns if c not in (*counts, "text")]
    rows = joined(docs.select(*kept, "text", row_key().alias("__key")), cuts, "__key")
    lines = F.split("text", "\n", -1)
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    gaps = F.zip_with(
        F.concat(F.array(F.lit(-1)), F.transform("__cuts", lambda c: c["hi"])),
        F.concat(F.transform("__cuts", lambda c: c["lo"]), F.array(F.col("n_lines").cast("int"))),
        lambda a, b: F.struct((a + 2).alias("at"), (b - a - 1).alias("n")),
    )
    left = F.flatten(F.transform(gaps, lambda g: F.slice(F.col("__lines"), g["at"], g["n"])))
    cut = F.coalesce("__cuts", F.array().cast("array<struct<lo:int,hi:int>>"))
    removed = F.aggregate(cut, F.lit(0).cast("long"), lambda n, c: n + c["hi"] - c["lo"] + 1)
    return (
        rows.withColumn("__lines", F.when(F.col("__cuts").isNotNull(), lines))
        # The second use of the lines keeps Catalyst from splitting the text anew for every gap.
        .withColumn("n_lines", F.coalesce(F.when(F.col("__cuts").isNotNull(), F.size("__lines")).otherwise(breaks + 1), F.lit(0)).cast("long"))
        .select(
            *[
                F.when(F.col("__cuts").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text")
                if c == "text"
                else F.col(c)
                for c in docs.columns
                if c == "text" or c in kept
            ],
            "n_lines",
            removed.alias("n_removed"),
            F.size(cut).cast("long").alias("n_runs"),
        )
    )
