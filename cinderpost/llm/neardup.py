"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderpost.llm.common import joined, row_key
from cinderpost.session import discard, ship_package, stage

WORD = r"[\p{L}\p{N}\p{M}]+"
GRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 80
# Shingles of one block of a bucket: what a task holds of a bucket at once is two blocks.
BLOCK_SHINGLES = 60_000
# Earlier bands by which a bucket is known to repeat the pairs of other buckets.
EARLIER = 4


def bands_and_rows(threshold: float, recall: float, most: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows a band: a pair at ``threshold`` shares a band with probability ``recall``.

    The most rows, and so the fewest false candidates, that ``most`` hashes allow.
    """
    best = None
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding reaches this recall with so few hashes")
    return best


def words(text: str = "text") -> Column:
    """Lower-cased runs of letters, digits and marks; null has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0))


def shingles(hashes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``gram`` words; of all words, if they are fewer."""
    h = np.asarray(hashes, dtype=np.int64).view(np.uint64)
    k = min(gram, len(h))
    if k == 0:
        return np.empty(0, np.uint64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out = (out ^ h[i : len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out ^= np.uint64(k)
    return np.unique(out * np.uint64(0xBF58476D1CE4E5B9))


def _signature(sets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of every hash function over a set, in slices of bounded size."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(sets), 4096):
        part = sets[at : at + 4096, None] * a + b
        np.minimum(low, part.min(axis=0), out=low)
    return low


def _bands(bands: int, rows: int, seed: int = 17):
    draws = np.random.default_rng(seed)
    a = draws.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = draws.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    mix = draws.integers(1, 1 << 63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    @F.pandas_udf("struct<n:int,bands:array<bigint>>")
    def banded(hashes: pd.Series) -> pd.DataFrame:
        sizes, found = [], []
        for h in hashes:
            own = shingles(h)
            sizes.append(len(own))
            low = (_signature(own, a, b) >> np.uint64(16)).reshape(bands, rows)
            keys = (low * mix).sum(axis=1, dtype=np.uint64) ^ np.arange(bands, dtype=np.uint64)
            keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            found.append(keys.view(np.int64))
        return pd.DataFrame({"n": sizes, "bands": found})

    return banded


@F.pandas_udf(T.BinaryType())
def _packed(hashes: pd.Series) -> pd.Series:
    return hashes.map(lambda h: shingles(h).tobytes())


def _similar(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets have at least ``threshold`` Jaccard similarity, as a matrix."""
    both = left + right
    sizes = np.array([len(s) for s in both])
    _, ids = np.unique(np.concatenate(both), return_inverse=True)
    owner = np.repeat(np.arange(len(both)), sizes)
    order = np.argsort(ids, kind="stable")
    ids, owner = ids[order], owner[order]
    common = np.zeros((len(left), len(right)), np.float32)
    distinct = int(ids[-1]) + 1 if len(ids) else 0
    width = max(64, 8_000_000 // max(1, len(both)))
    for lo in range(0, distinct, width):
        at, to = np.searchsorted(ids, [lo, lo + width])
        dense = np.zeros((len(both), min(width, distinct - lo)), np.float32)
        dense[owner[at:to], ids[at:to] - lo] = 1
        common += dense[: len(left)] @ dense[len(left) :].T
    # Counts are exact in float32 up to 2^24 shingles; integers decide.
    common = np.rint(common).astype(np.int64)
    union = sizes[: len(left), None] + sizes[None, len(left) :] - common
    scale = 1_000_000
    return (common > 0) & (common * scale >= union * round(threshold * scale))


def _smallest_in_component(links: np.ndarray) -> np.ndarray:
    """Per member the smallest index of its component, by propagation with shortcuts."""
    label = np.arange(len(links))
    while True:
        near = np.where(links, label[None, :], len(links)).min(axis=1)
        after = np.minimum(label, near)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def _verifier(threshold: float):
    """Rows of (bucket, part, side, ...) sorted by bucket and part to links of the members.

    A ``diagonal`` part pairs one block with itself; any other pairs two, either may be empty.
    """

    def block(rows: list) -> Iterator[tuple]:
        seen, members = set(), []
        for r in rows:
            if (r.side, r.rep) not in seen:
                seen.add((r.side, r.rep))
                members.append(r)
        left = [r for r in members if r.side == 0]
        right = left if rows and rows[0].diagonal else [r for r in members if r.side == 1]
        if len(members) < 2 or not left or not right:
            return
        bands = lambda part: np.stack([np.asarray(r.bands, np.int64) for r in part])
        band = left[0].band
        lb, rb = bands(left), bands(right)
        new = np.ones((len(left), len(right)), bool)
        for b in range(band):  # a pair is counted in the first band it shares
            new &= lb[:, b, None] != rb[None, :, b]
        if right is left:
            np.fill_diagonal(new, False)
        if not new.any():
            return
        sets = lambda part: [np.frombuffer(r.shingles, np.uint64) for r in part]
        similar = new & _similar(sets(left), sets(right), threshold)
        copies = lambda part: np.array([r.copies for r in part], np.int64)
        if right is left:
            label, counts = _smallest_in_component(similar), similar @ copies(left)
            for i, r in enumerate(left):
                if counts[i]:
                    yield r.rep, left[label[i]].rep, int(counts[i])
            return
        n = len(left)
        whole = np.zeros((n + len(right),) * 2, bool)
        whole[:n, n:] = similar
        whole[n:, :n] = similar.T
        label = _smallest_in_component(whole)
        every, counts = left + right, np.concatenate([similar @ copies(right), copies(left) @ similar])
        for i, r in enumerate(every):
            if counts[i]:
                yield r.rep, every[label[i]].rep, int(counts[i])

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, at = [], None
        out: list[tuple] = []
        for batch in batches:
            for r in batch.itertuples(index=False):
                if at != (r.bucket, r.part):
                    out.extend(block(rows))
                    rows, at = [], (r.bucket, r.part)
                rows.append(r)
            yield pd.DataFrame(out, columns=["src", "dst", "links"])
            out = []
        out.extend(block(rows))
        yield pd.DataFrame(out, columns=["src", "dst", "links"])

    return verify


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per node the smallest node of its component: node, label. ``edges`` has src, dst.

    Rounds of taking the smallest label among the neighbours, then that label's own label; each
    round is written, the edges are never collected, and the number of rounds grows with the
    logarithm of the longest path.
    """
    ways = stage(
        edges.select("src", "dst").union(edges.select(F.col("dst"), F.col("src"))).distinct(), "ways"
    )
    labels = stage(nodes.select("node", F.col("node").alias("label")), "labels")
    while True:
        near = ways.join(labels, ways["dst"] == labels["node"]).groupBy("src").agg(F.min("label").alias("near"))
        lower = stage(
            labels.join(near, labels["node"] == near["src"], "left").select(
                "node", F.least("label", F.coalesce("near", "label")).alias("label"), F.col("label").alias("old")
            ),
            "labels",
        )
        roots = lower.select(F.col("node").alias("label"), F.col("label").alias("root"))
        after = stage(
            lower.join(roots, "label", "left").select("node", F.least("label", "root").alias("label"), "old"), "labels"
        )
        moved = after.filter("label != old").limit(1).count()
        discard(labels, lower)
        labels = after.select("node", "label")
        labels._stage_path = after._stage_path
        if not moved:
            discard(ways)
            return labels


def near_duplicates(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK_SHINGLES
) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, and _key.

    Two documents are linked if their sets of five-word shingles have a Jaccard similarity of
    ``threshold`` or more; n_links counts a document's partners and class_id is the smallest
    doc_id that links lead to.

    1. Texts of equal words are one text with a number of copies; they are linked to each other.
    2. Every text gets MinHash bands; a shuffle on band hashes finds buckets of two or more.
    3. Members of buckets get their full shingle sets and every pair of a bucket is verified, in
       the first band that it shares. A bucket is dealt into blocks of bounded size, chosen by a
       hash, and each pair of blocks is verified apart, so no task holds more than two blocks. A
       task returns one row per member, not per pair: its number of links and the smallest
       member that the links of these blocks lead to.
    4. Those rows span all links, so their components are the classes.

    Null, empty and wordless texts have no links and are their own class. Texts of fewer than
    five words are one shingle. Rows with the same id and text each count as a document. Null
    ids come first in the order of a class; extra columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bands, rows = bands_and_rows(threshold, recall)
    hashed = F.transform("_words", lambda w: F.xxhash64(w))
    every = docs.select("doc_id", row_key().alias("_key"), words().alias("_words")).withColumn(
        "_same", F.when(F.size("_words") > 0, F.md5(F.array_join("_words", " ")))
    )
    signed = stage(
        every.withColumn("_b", F.when(F.size("_words") > 0, _bands(bands, rows)(hashed))).select(
            "doc_id", "_key", "_same", F.col("_b.n").alias("_n"), F.col("_b.bands").alias("_bands")
        ),
        "signatures",
    )
    texts = stage(
        signed.filter("_same IS NOT NULL")
        .groupBy("_same")
        .agg(
            F.min(F.struct("doc_id", "_key")).alias("_first"),
            F.count("*").alias("_copies"),
            F.min("_n").alias("_n"),
            F.first("_bands").alias("_bands"),
        ),
        "texts",
    )
    early = [f"_e{i}" for i in range(min(EARLIER, bands))]
    places = texts.select(
        F.col("_same").alias("rep"),
        *[F.get("_bands", F.lit(i)).alias(c) for i, c in enumerate(early)],
        F.posexplode_outer("_bands").alias("band", "bucket"),
    )
    buckets = stage(
        texts.select("_n", F.explode_outer("_bands").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("_m"), F.sum("_n").alias("_mass"))
        .filter("_m > 1")
        .select("bucket", F.ceil(F.col("_mass") / F.lit(block)).cast("int").alias("_blocks")),
        "buckets",
    )
    found = stage(joined(places, buckets, "bucket", "inner"), "members")
    known = F.lit(False)
    for i, c in enumerate(early):
        known = known | ((F.min("band") > i) & (F.min(c) == F.max(c)))
    useful = stage(found.groupBy("bucket").agg(known.alias("_known")).filter("NOT _known").select("bucket"), "useful")
    members = stage(joined(found, useful, "bucket", "left_semi").drop(*early), "members")
    discard(found, useful)
    some = stage(members.select("rep").distinct(), "candidates")
    wanted = stage(
        joined(texts.select(F.col("_same").alias("rep"), "_first._key", "_copies", "_bands"), some, "rep", "left_semi"),
        "wanted",
    )
    # The texts of candidates are read again, as shingle sets are larger than texts.
    again = joined(
        docs.select(row_key().alias("_key"), words().alias("_words")),
        wanted.select("_key", "rep"),
        "_key",
        "inner",
    )
    sets = stage(
        again.select("rep", _packed(hashed).alias("shingles")).dropDuplicates(["rep"]).join(
            wanted.select("rep", F.col("_copies").alias("copies"), F.col("_bands").alias("bands")), "rep"
        ),
        "shingle-sets",
    )
    own = F.pmod(F.xxhash64("rep", F.lit(7)), F.col("_blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda o: F.struct(
            F.least(o, F.col("_own")).alias("a"),
            F.greatest(o, F.col("_own")).alias("b"),
            (F.col("_own") > o).cast("int").alias("side"),
        ),
    )
    dealt = members.withColumn("_own", own).withColumn("_p", F.explode_outer(pairs)).select(
        "rep",
        "band",
        "bucket",
        (F.col("_p.a") * F.col("_blocks") + F.col("_p.b")).cast("long").alias("part"),
        F.col("_p.side").alias("side"),
        (F.col("_p.a") == F.col("_p.b")).alias("diagonal"),
    )
    tasks = (
        dealt.join(sets, "rep")
        .repartition(F.col("bucket"), F.col("part"))
        .sortWithinPartitions("bucket", "part", "side")
    )
    links = stage(
        tasks.select("bucket", "part", "side", "diagonal", "band", "rep", "copies", "bands", "shingles").mapInPandas(
            _verifier(threshold), "src string, dst string, links long"
        ),
        "links",
    )
    discard(sets, members, some, buckets)
    counts = links.groupBy("src").agg(F.sum("links").alias("_links"))
    ids = wanted.select(F.col("rep").alias("node"))
    label = components(links.filter("src != dst"), ids)
    firsts = texts.select(F.col("_same").alias("node"), "_first")
    classes = (
        label.join(firsts, "node")
        .groupBy("label")
        .agg(F.min("_first").alias("_class"))
        .join(label, "label")
        .select("node", "_class")
    )
    facts = stage(
        texts.select(F.col("_same").alias("node"), "_first", "_copies")
        .join(classes, "node", "left")
        .join(counts.withColumnRenamed("src", "node"), "node", "left")
        .select(
            F.col("node").alias("_same"),
            F.coalesce("_class", "_first").alias("_class"),
            (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("n_links"),
        ),
        "classes",
    )
    discard(texts, wanted, links, label)
    return joined(signed.select("doc_id", "_key", "_same"), facts, "_same").select(
        "doc_id",
        "_key",
        F.when(F.col("_class").isNull(), F.col("doc_id")).otherwise(F.col("_class.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("_class").isNull() | (F.col("_class._key") == F.col("_key"))).alias("first"),
    )


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The first document, by id, of every class, with all its columns.

    Rows that share id and text are told apart by nothing, so one of them stays. Names of
    columns that begin with two underscores are reserved.
    """
    found = near_duplicates(docs, **settings)
    rest = stage(found.filter("NOT first").select(F.col("_key").alias("__key")).distinct(), "later-copies")
    rows = docs.withColumn("__key", row_key())
    kept = joined(rows, rest, "__key", "left_anti")
    repeated = stage(
        found.filter("first AND n_links > 0").groupBy("_key").count().filter("count > 1").select(F.col("_key").alias("__key")),
        "repeated-rows",
    )
    single = joined(kept, repeated, "__key", "left_anti")
    double = joined(kept, repeated, "__key", "left_semi").dropDuplicates(["__key"])
    return single.unionByName(double).drop("__key")
