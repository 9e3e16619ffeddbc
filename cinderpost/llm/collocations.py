"""Phrase collocations: suffix pointers sorted by multikey quicksort, counts from equal partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderpost.llm.common import LOWER, UPPER, joined
from cinderpost.session import discard, ship_package, stage

# What ends a piece, what lies between words.
BREAKS = ".,;:!?\n\x0b\x0c\r"
TOKEN = r"[^\x20\x09.,;:!?\x0A-\x0D]+|[.,;:!?\x0A-\x0D]+"

LEAST = 10
LONGEST = 3
ABSORBED = 50
TOP = 2000
# Words of a shard, and suffixes that a task sorts before it sends them there.
SHARD_WORDS = 500_000
FLUSH = 500_000
# Pairs of two of the most frequent words are routed by their third word as well.
HOT_WORDS = 1 << 16
# Partitions of the quicksort of so many suffixes are sorted at once.
SMALL = 4096
# Parts of a language that are ranked apart before they meet.
PARTS = 64
# Word ids are 64-bit hashes; when two words of the corpus share one, another seed is taken.
SEEDS = 8


def _tokens() -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(TOKEN), F.lit(0))


def _is_break(token: Column) -> Column:
    return F.contains(F.lit(BREAKS), F.left(token, F.lit(1)))


def _lang() -> Column:
    return F.coalesce("lang", F.lit("und"))


def _word_counts(docs: DataFrame) -> tuple[DataFrame, int]:
    """Words of every language with a number of their own: lang, word, f, id; and the seed."""
    tokens = docs.select(_lang().alias("lang"), F.explode_outer(_tokens()).alias("word"))
    counted = stage(
        tokens.filter(F.col("word").isNotNull() & ~_is_break(F.col("word"))).groupBy("lang", "word").agg(F.count("*").alias("f")),
        "word-counts",
    )
    for seed in range(SEEDS):
        words = counted.withColumn("id", F.xxhash64("lang", "word", F.lit(seed)))
        shared = words.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1 OR id = 0")
        if not shared.limit(1).count():
            return words, seed
    raise RuntimeError("no seed gives every word an id of its own")


def _mixed(ids: np.ndarray) -> np.ndarray:
    """Hash of the words in the rows of ``ids``, one per column."""
    out = np.zeros(ids.shape[1], np.uint64)
    for row in ids:
        out = (out ^ row.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def _both_hot(ids: np.ndarray, hot: np.ndarray) -> np.ndarray:
    return np.isin(ids[0], hot) & np.isin(ids[1], hot)


def _runs(ids: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal columns."""
    return np.flatnonzero(np.append(True, (ids[:, 1:] != ids[:, :-1]).any(axis=0)))


def _suffix_blocks(longest: int, shards: int, hot: np.ndarray):
    """Arrow batches of word ids (null: end of a piece) to blocks of distinct suffixes by shard.

    A suffix is a place with its first ``longest`` words, 0 beyond the piece's end. Suffixes go
    by their first two words, and by a third where both are hot.
    """

    def blocks(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate(held, axis=1)
        ids = ids[:, np.lexsort(ids[::-1])]
        starts = _runs(ids)
        weights = np.diff(np.append(starts, ids.shape[1]))
        ids = ids[:, starts]
        route = _mixed(ids[:2])
        far = _both_hot(ids, hot)
        route[far] = _mixed(ids[: min(3, longest), far])
        shard = (route % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        at = np.append(np.flatnonzero(np.append(True, np.diff(shard[order]) > 0)), len(order))
        packed = np.concatenate([ids, weights[None, :]])[:, order]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(shard[order][at[:-1]], pa.int64()),
                pa.array([packed[:, a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()),
            ],
            names=["shard", "block"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            values = batch.column(0).flatten()
            for at in range(0, len(values), FLUSH):
                own = values.slice(at, FLUSH + longest - 1).fill_null(0).to_numpy(zero_copy_only=False)
                size = min(FLUSH, len(values) - at)
                padded = np.concatenate([own, np.zeros(longest, np.int64)])
                ids = np.stack([padded[j : j + size] for j in range(longest)])
                for j in range(1, longest):
                    ids[j][ids[j - 1] == 0] = 0
                held.append(ids[:, ids[1] != 0])
                n += held[-1].shape[1]
                if n >= FLUSH:
                    yield from blocks(held)
                    held, n = [], 0
        if n:
            yield from blocks(held)

    return run


def phrase_counts(ids: np.ndarray, weights: np.ndarray, least: int, routed: int = 2) -> list[tuple[np.ndarray, np.ndarray]]:
    """Phrases of two words or more with their weights: (ids, sums) of each length.

    Multikey quicksort of pointers to suffixes: a partition is split by the word at its depth into
    smaller, equal and larger; the equal part shares a phrase, its weight is the phrase's count,
    and it goes on at the next depth. ``ids`` holds one suffix a column, 0 where it ends. All
    suffixes that share their first ``routed`` words are here, so partitions of such phrases are
    abandoned below ``least``; shorter phrases are returned with whatever weight they have here.
    """
    longest = len(ids)
    found: list[list] = [[] for _ in range(longest + 1)]
    pointers = np.arange(ids.shape[1])
    open_parts = [(0, len(pointers), 0)]
    while open_parts:
        lo, hi, depth = open_parts.pop()
        part = pointers[lo:hi]
        if lo == hi or (max(depth + 1, 2) >= routed and weights[part].sum() < least):
            continue
        if hi - lo <= SMALL:
            rest = ids[depth:, part]
            order = np.lexsort(rest[::-1])
            part, rest = part[order], rest[:, order]
            for length in range(max(depth + 1, 2), longest + 1):
                starts = _runs(rest[: length - depth])
                sums = np.add.reduceat(weights[part], starts)
                good = (rest[length - depth - 1, starts] != 0) & ((sums >= least) | (length < routed))
                found[length].append((ids[:length, part[starts[good]]], sums[good]))
            continue
        keys = ids[depth, part]
        pivot = np.sort(keys[[0, len(keys) // 2, -1]])[1]
        less, equal = keys < pivot, keys == pivot
        same = part[equal]
        pointers[lo:hi] = np.concatenate([part[less], same, part[~(less | equal)]])
        a = lo + int(less.sum())
        b = a + len(same)
        open_parts += [(lo, a, depth), (b, hi, depth)]
        if pivot != 0:
            total = weights[same].sum()
            if depth + 1 >= 2 and (total >= least or depth + 1 < routed):
                found[depth + 1].append((ids[: depth + 1, same[:1]], np.array([total])))
            if depth + 1 < longest:
                open_parts.append((a, b, depth + 1))
    return [
        (np.concatenate([x for x, _ in own], axis=1), np.concatenate([s for _, s in own])) if own else (np.zeros((k, 0), np.int64), np.zeros(0, np.int64))
        for k, own in enumerate(found)
    ][2:]


def _shard_counts(longest: int, least: int, hot: np.ndarray):
    def run(blocks: pd.DataFrame) -> pd.DataFrame:
        every = np.concatenate([np.frombuffer(b, np.int64).reshape(longest + 1, -1) for b in blocks["block"]], axis=1)
        ids, weights = every[:-1], every[-1]
        far = _both_hot(ids, hot)
        phrases, sums = [], []
        for some, routed in ((~far, 2), (far, min(3, longest))):
            for own, n in phrase_counts(np.ascontiguousarray(ids[:, some]), weights[some], least, routed):
                phrases += list(own.T)
                sums += n.tolist()
        return pd.DataFrame({"ids": pd.Series(phrases, dtype=object), "n": pd.Series(sums, dtype="int64")})

    return run


def _frequent(docs: DataFrame, words: DataFrame, seed: int, total: int, longest: int, least: int) -> DataFrame:
    """Phrases of two words or more that occur ``least`` times: ids, f."""
    shards = max(1, -(-total // SHARD_WORDS))
    floor = max(SHARD_WORDS // 4, total // HOT_WORDS)
    hot = np.array([r["id"] for r in words.filter(F.col("f") > floor).select("id").collect()], np.int64)
    ids = F.transform("_t", lambda t: F.when(~_is_break(t), F.xxhash64("_lang", t, F.lit(seed))))
    closed = F.concat(ids, F.array(F.lit(None).cast("long")))
    tokens = docs.select(_lang().alias("_lang"), _tokens().alias("_t")).select(closed.alias("ids"))
    blocks = tokens.mapInArrow(_suffix_blocks(longest, shards, hot), "shard long, block binary")
    partial = blocks.groupBy("shard").applyInPandas(_shard_counts(longest, least, hot), "ids array<bigint>, n long")
    # Pairs of hot words come from several shards.
    return stage(partial.groupBy("ids").agg(F.sum("n").alias("f")).filter(F.col("f") >= least), "frequent-phrases")


def _parts(longest: int, f: Column) -> Column:
    """Phrases of two words or more that lie inside a phrase, each with the phrase's count."""
    n = F.size("ids")
    inside = [
        F.when((n > k) & (n >= at + k), F.struct(F.slice("ids", at + 1, k).alias("part"), f.alias("around")))
        for k in range(2, longest)
        for at in range(longest - k + 1)
    ]
    kind = "array<struct<part:array<bigint>,around:bigint>>"
    return F.array_compact(F.array(*inside)) if inside else F.array().cast(kind)


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, absorbed: int = ABSORBED, top: int = TOP
) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased; texts are cut into pieces at . , ; : ! ? and line ends, pieces into words
    at blanks and tabs. Phrases are runs of 2 to ``longest`` words of a piece; a is the number of
    their places, ``least`` or more. A cut leaves a first part with l places and a rest with r;
    score = floor(10^6 * a * a / (l * r)) of the cut that has the lowest, the earliest of several.
    Phrases inside a longer phrase with ``absorbed`` percent of their places or more are left out.
    n is the number of all words of the language. Order: score and a falling, phrase rising.

    1. Words are counted and numbered by a hash that is checked to be unique.
    2. Every task cuts its suffixes to ``longest`` words and adds equal ones up. Distinct suffixes
       are routed by their first two words, so that all with a phrase meet in one shard; pairs of
       very frequent words by a third word as well, their counts are added up behind the sort.
       Shards hold about SHARD_WORDS words, however many tasks there are.
    3. Shards sort pointers to suffixes by three-way partitions, word by word to the full depth;
       partitions of too few places are abandoned.
    4. Scores, cuts and absorption are joins among the frequent phrases.

    Null and empty texts have no words; a null language is ``und``, an empty one stays. Repeated
    rows count each time, ids and other columns are ignored. Products beyond 38 digits are an error.
    """
    if longest < 2:
        raise ValueError("phrases have two words or more")
    ship_package(docs.sparkSession)
    words, seed = _word_counts(docs)
    total = words.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("n")).first()["n"]
    sizes = stage(words.groupBy("lang").agg(F.sum("f").alias("n")), "language-sizes")
    known = stage(words.filter(F.col("f") >= least), "frequent-words")
    phrases = _frequent(docs, known, seed, total, longest, least)
    counts = stage(
        phrases.select(F.col("ids").alias("part"), F.col("f").alias("n_part")).unionByName(
            known.select(F.array("id").alias("part"), F.col("f").alias("n_part"))
        ),
        "phrase-counts",
    )
    cut = F.posexplode_outer(F.sequence(F.lit(1), F.size("ids") - 1)).alias("_", "k")
    cuts = phrases.select("ids", F.col("f").alias("a"), cut).select(
        "ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("head"), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("tail")
    )
    heads = counts.select(F.col("part").alias("head"), F.col("n_part").alias("l"))
    tails = counts.select(F.col("part").alias("tail"), F.col("n_part").alias("r"))
    wide = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r")}
    score = F.expr("CAST(1000000 AS DECIMAL(38,0)) * _a * _a div (_l * _r)")
    scored = (
        joined(joined(cuts, heads, "head", "inner"), tails, "tail", "inner")
        .withColumns({f"_{c}": wide[c] for c in wide})
        .withColumn("score", score.cast("long"))
        .groupBy("ids")
        .agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("_best"))
    )
    around = stage(
        phrases.select(F.explode_outer(_parts(longest, F.col("f"))).alias("_p"))
        .filter("_p IS NOT NULL")
        .groupBy(F.col("_p.part").alias("ids"))
        .agg(F.max("_p.around").alias("_around")),
        "phrases-around",
    )
    scored = joined(scored, around, "ids").filter(
        F.col("_around").isNull() | (F.col("_around") * 100 < F.col("a") * absorbed)
    )
    rows = stage(scored.select("ids", "a", "_best.l", "_best.r", "_best.score"), "scored-phrases")
    spelled = (
        joined(
            rows.select("ids", F.posexplode_outer("ids").alias("_i", "id")), known.select("id", "lang", "word"), "id", "inner"
        )
        .groupBy("ids")
        .agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("_i", "word"))).alias("_w"))
        .select("ids", "lang", F.array_join(F.transform("_w", lambda w: w["word"]), " ").alias("phrase"))
    )
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    # A language is ranked in parts first, so that no task gets more than the best of each.
    parts = Window.partitionBy("lang", "_part").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    dealt = rows.join(spelled, "ids").withColumn("_part", F.pmod(F.xxhash64("ids"), F.lit(PARTS)))
    leading = dealt.withColumn("_first", F.row_number().over(parts)).filter(F.col("_first") <= top)
    ranked = leading.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    listed = stage(ranked.select("lang", "rank", "phrase", "a", "l", "r", "score"), "collocations")
    discard(known, phrases, counts, rows, around)
    return joined(listed, sizes, "lang", "inner").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
