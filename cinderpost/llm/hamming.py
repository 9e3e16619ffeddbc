"""MinHash near-dedup: b-bit signatures joined within a Hamming distance by masked chunks."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderpost.llm.common import LOWER, UPPER, joined, row_key
from cinderpost.llm.mixing import WORD
from cinderpost.llm.neardup import components, shingles
from cinderpost.session import discard, ship_package, stage

PERCENT = 85
VALUES = 64
BITS = 16
# Share of pairs at the threshold whose signatures may be further apart than the distance.
LOSS = 1e-5
# Wrong values allowed in a chunk: a chunk is enumerated with each of its values masked.
ERRORS = 1
# What a task holds of a bucket at once is two blocks of this many shingles or values.
BLOCK = 60_000
# Parts of so few members are compared together.
FEW = 16
# Pairs with one centre that one task joins to it.
PER_CENTRE = 1000


@dataclass(frozen=True)
class Chunks:
    """Signatures within ``distance`` differ in at most ERRORS values of some chunk (pigeonhole)."""

    distance: int
    starts: tuple[int, ...]
    values: int

    def bounds(self) -> list[tuple[int, int]]:
        return list(zip(self.starts, (*self.starts[1:], self.values)))


def plan(percent: int = PERCENT, values: int = VALUES, loss: float = LOSS) -> Chunks:
    """Distance that all but ``loss`` of the pairs at the threshold keep, and the chunks for it.

    Values of two sets differ with probability 1 - similarity at most, independently.
    """
    differ = 1 - percent / 100
    tail, distance = 1.0, -1
    while tail > loss and distance < values:
        distance += 1
        tail -= math.comb(values, distance) * differ**distance * (1 - differ) ** (values - distance)
    n = distance // (ERRORS + 1) + 1
    if values < n * (ERRORS + 2):
        raise ValueError("signatures are too short for this threshold")
    return Chunks(distance, tuple(values * i // n for i in range(n)), values)


def _words(text: str) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _draws(values: int, seed: int = 12) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, (3, values), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _signed(values: int):
    a, b, mix = _draws(values)

    def signature(own: np.ndarray) -> bytes:
        low = np.full(values, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(own), 4096):
            np.minimum(low, (own[at : at + 4096, None] * a + b).min(axis=0), out=low)
        return ((low * mix) >> np.uint64(64 - BITS)).astype(np.uint16).tobytes()

    @F.pandas_udf("struct<n:long,same:binary,sig:binary>")
    def signed(hashes: pd.Series) -> pd.DataFrame:
        rows = []
        for h in hashes:
            own = shingles(h) if h is not None else ()
            rows.append((len(own), hashlib.md5(own.tobytes()).digest(), signature(own)) if len(own) else (0, None, None))
        return pd.DataFrame(rows, columns=["n", "same", "sig"])

    return signed


def _matrix(sigs) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), np.uint16).reshape(len(sigs), -1)


def _masked(chunks: Chunks):
    """Per masked value the hash of the rest of its chunk; place and chunk are part of the hash."""
    mult, place, _ = _draws(chunks.values, 13)

    @F.pandas_udf("array<bigint>")
    def masked(sigs: pd.Series) -> pd.Series:
        if not len(sigs):
            return pd.Series([], dtype=object)
        terms = (_matrix(sigs).astype(np.uint64) + np.uint64(1)) * mult
        terms ^= terms >> np.uint64(31)
        terms *= place
        keys = np.empty_like(terms)
        for at, to in chunks.bounds():
            keys[:, at:to] = terms[:, at:to].sum(axis=1, dtype=np.uint64)[:, None] - terms[:, at:to]
        keys = (keys ^ place) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
        return pd.Series(list((keys * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)))

    return masked


@F.pandas_udf(T.BinaryType())
def _packed(hashes: pd.Series) -> pd.Series:
    return hashes.map(lambda h: shingles(h).tobytes())


@F.pandas_udf(T.IntegerType())
def _apart(left: pd.Series, right: pd.Series) -> pd.Series:
    """Values in which two signatures differ."""
    if not len(left):
        return pd.Series([], dtype="int32")
    return pd.Series((_matrix(left) != _matrix(right)).sum(axis=1).astype("int32"))


def _similar_pair(percent: int):
    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(left, right):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * common >= percent * (len(a) + len(b) - common))
        return pd.Series(out, dtype=bool)

    return similar


def _meet(wrong: np.ndarray, place: np.ndarray, chunks: Chunks) -> np.ndarray:
    """Pairs (rows: which values differ) within the distance that no bucket of an earlier place has."""
    out = wrong.sum(axis=1) <= chunks.distance
    wrong = wrong[out]
    errors = np.add.reduceat(wrong, chunks.starts, axis=1, dtype=np.int32)
    first = np.argmax(errors <= ERRORS, axis=1)
    at = np.array(chunks.starts)[first]
    # Of an equal chunk its first value counts as the masked one.
    one = errors[np.arange(len(first)), first] == 1
    for k, (lo, hi) in enumerate(chunks.bounds()):
        mine = one & (first == k)
        if mine.any():
            at[mine] = lo + np.argmax(wrong[mine, lo:hi], axis=1)
    out[out] = at == place[out]
    return out


def _eligible(left: pd.DataFrame, right: pd.DataFrame, place: int, chunks: Chunks) -> np.ndarray:
    """Pairs within the distance, not linked yet, that no bucket of an earlier place has as well."""
    a, b = _matrix(left["sig"].tolist()), _matrix(right["sig"].tolist())
    out = left["label"].to_numpy()[:, None] != right["label"].to_numpy()[None, :]
    for i in range(len(a)):
        js = np.flatnonzero(out[i])
        out[i, js] = _meet(a[i] != b[js], np.full(len(js), place), chunks)
    return out


def _whole_parts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Batches that end with a part, and where parts begin; rows come sorted by bucket and part."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        ends = batch[["bucket", "part"]].iloc[-1]
        last = ((batch["bucket"] == ends["bucket"]) & (batch["part"] == ends["part"])).to_numpy()
        first = held and (held[-1][["bucket", "part"]].iloc[-1] == ends).all()
        if last.all() and (first or not held):
            held.append(batch)
            continue
        yield _with_starts(pd.concat([*held, batch[~last]], ignore_index=True))
        held = [batch[last]]
    if held:
        yield _with_starts(pd.concat(held, ignore_index=True))


def _with_starts(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    new = np.append(True, (np.diff(rows["bucket"]) != 0) | (np.diff(rows["part"]) != 0))
    return rows, np.flatnonzero(new)


def _blocks(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    left = rows[rows["side"] == 0]
    return left, left if rows["diagonal"].iloc[0] else rows[rows["side"] == 1]


def _live(chunks: Chunks):
    """Members of parts that have a partner to be verified; without their signatures."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, starts in _whole_parts(batches):
            sizes = np.diff(np.append(starts, len(rows)))
            live = np.zeros(len(rows), bool)
            few = np.repeat((sizes <= FEW) & rows["diagonal"].to_numpy()[starts], sizes)
            part = np.repeat(np.arange(len(starts)), sizes)
            sigs, labels, places = _matrix(rows["sig"].tolist()), rows["label"].to_numpy(), rows["place"].to_numpy()
            # Members of small parts meet all at once: each with the one d rows on.
            for d in range(1, min(FEW, len(rows))):
                i = np.flatnonzero(few[:-d] & (part[:-d] == part[d:]) & (labels[:-d] != labels[d:]))
                i = i[_meet(sigs[i] != sigs[i + d], places[i], chunks)]
                live[i] = live[i + d] = True
            for at, size in zip(starts, sizes):
                if not few[at]:
                    own = rows.iloc[at : at + size]
                    left, right = _blocks(own)
                    if len(left) and len(right):
                        able = _eligible(left, right, left["place"].iloc[0], chunks)
                        live[left.index[able.any(axis=1)]] = True
                        live[right.index[able.any(axis=0)]] = True
            yield rows[live].drop(columns="sig")

    return run


def _verified(percent: int, chunks: Chunks):
    """Links between labels, as few as connect what the links of a part connect."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for left, right in (_blocks(rows.iloc[a:b]) for rows, at in _whole_parts(batches) for a, b in zip(at, [*at[1:], len(rows)])):
            if not len(left) or not len(right):
                continue
            able = _eligible(left, right, left["place"].iloc[0], chunks)
            if right is left:
                able = np.triu(able)
            labels, others = left["label"].tolist(), right["label"].tolist()
            root = {x: x for x in {*labels, *others}}

            def top(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            sets = [np.frombuffer(s, np.uint64) for s in right["shingles"]]
            every = np.concatenate(sets)
            sizes = np.array([len(s) for s in sets])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            found = []
            for i in np.flatnonzero(able.any(axis=1)):
                own = np.frombuffer(left["shingles"].iloc[i], np.uint64)
                at = np.minimum(np.searchsorted(own, every), len(own) - 1)
                common = np.add.reduceat(own[at] == every, starts, dtype=np.int64)
                similar = able[i] & (100 * common >= percent * (len(own) + sizes - common))
                for j in np.flatnonzero(similar):
                    a, b = top(labels[i]), top(others[j])
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        found.append((labels[i], others[j]))
            if found:
                yield pd.DataFrame(found, columns=["src", "dst"])

    return run


def _with_centre(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """Pairs (rep, centre) with ``values`` of both, ``name`` and ``name``2.

    Centres with many pairs get several copies of their row, so that no task joins all of them.
    """
    many = stage(
        pairs.groupBy("centre").agg(F.count("*").alias("_n")).filter(F.col("_n") > PER_CENTRE)
        .select("centre", F.ceil(F.col("_n") / F.lit(PER_CENTRE)).cast("int").alias("_copies")),
        "many",
    )
    copies = F.coalesce("_copies", F.lit(1))
    salted = joined(pairs, many, "centre").withColumn("_salt", F.pmod(F.xxhash64("rep"), copies).cast("int"))
    centres = joined(values.select(F.col("rep").alias("centre"), F.col(name).alias(f"{name}2")), many, "centre").withColumn(
        "_salt", F.explode_outer(F.sequence(F.lit(0), copies - 1))
    )
    return (
        salted.drop("_copies")
        .join(centres.drop("_copies"), ["centre", "_salt"])
        .drop("_salt")
        .join(values.select("rep", name), "rep")
    )


def _late_links(
    found: DataFrame, label: DataFrame, sets: DataFrame, percent: int, chunks: Chunks, block: int
) -> DataFrame:
    """Links of pairs that share a bucket and that the links with centres don't connect yet.

    A bucket is dealt into blocks by a hash; each pair of blocks is a part. In a first pass the
    parts see signatures only; members without a partner in reach are done. The second pass has
    the shingle sets of the others.
    """
    named = found.select("rep", "bucket", "place").join(label.select(F.col("node").alias("rep"), "label"), "rep")
    mass = F.sum(F.greatest("n", F.lit(VALUES)))
    open_buckets = stage(
        named.join(sets.select("rep", "n"), "rep")
        .groupBy("bucket")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"), mass.alias("_mass"))
        .filter("lo != hi")
        .select("bucket", F.ceil(F.col("_mass") / F.lit(block)).cast("int").alias("_blocks")),
        "open-buckets",
    )
    own = F.pmod(F.xxhash64("rep", F.lit(5)), F.col("_blocks")).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda o: F.struct(
            F.least(o, F.col("_own")).alias("a"),
            F.greatest(o, F.col("_own")).alias("b"),
            (F.col("_own") > o).cast("int").alias("side"),
        ),
    )
    dealt = (
        joined(named, open_buckets, "bucket", "inner")
        .withColumn("_own", own)
        .withColumn("_p", F.explode_outer(parts))
        .select(
            "bucket",
            (F.col("_p.a") * F.col("_blocks") + F.col("_p.b")).cast("long").alias("part"),
            F.col("_p.side").alias("side"),
            (F.col("_p.a") == F.col("_p.b")).alias("diagonal"),
            "place",
            "rep",
            "label",
        )
    )
    schema = "bucket long, part long, side int, diagonal boolean, place int, rep long, label long"

    def met(rows: DataFrame, *values: str) -> DataFrame:
        return (
            rows.join(sets.select("rep", *values), "rep")
            .repartition("bucket", "part")
            .sortWithinPartitions("bucket", "part", "side")
            .select("bucket", "part", "side", "diagonal", "place", "rep", "label", *values)
        )

    live = stage(met(dealt, "sig").mapInPandas(_live(chunks), schema), "live")
    links = stage(
        met(live, "sig", "shingles").mapInPandas(_verified(percent, chunks), "src long, dst long").distinct(), "late-links"
    )
    discard(open_buckets, live)
    return links


def deduplicated(
    docs: DataFrame, percent: int = PERCENT, values: int = VALUES, loss: float = LOSS, block: int = BLOCK
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    A-Z are lower-cased; words are what lies between ASCII white space. Documents are linked if
    the sets of their distinct five-word shingles (all words, if there are fewer) have 100 times
    their common part at ``percent`` times their union or more. component_id is the smallest
    doc_id that links lead to, kept says that it is the document's own.

    1. Every set gets a signature of ``values`` MinHash values of 16 bits. Equal sets are one.
    2. Signatures are cut into chunks. Two within the distance of ``plan`` differ in one value of
       some chunk at most, so they agree in a chunk with that value masked: each signature is
       shuffled once per masked value, and every such pair meets in a bucket.
    3. Members of a bucket are verified with its smallest member on full sets; these links give
       classes. Pairs of a bucket that are still in different classes and within the distance are
       verified where blocks of the bucket meet. Tasks return connecting links, never all pairs.

    A pair at the threshold lies beyond the distance, and may be missed, with a probability of
    ``loss``. Null, empty and wordless texts have no shingles and no links. Null ids are left out
    of a class's smallest id; a class of null ids has a null one, which its documents keep. Rows
    with equal id and text are documents like others: all that carry a class's id are kept. Extra
    columns are ignored, whatever their names.
    """
    ship_package(docs.sparkSession)
    chunks = plan(percent, values, loss)
    hashed = F.transform(_words("text"), lambda w: F.xxhash64(w))
    signed = stage(
        docs.select("doc_id", row_key().alias("_key"), _signed(values)(hashed).alias("_s")).select(
            "doc_id", "_key", F.col("_s.n").alias("n_shingles"), F.col("_s.same").alias("same"), F.col("_s.sig").alias("sig")
        ),
        "b-bit-signatures",
    )
    texts = stage(
        signed.filter("same IS NOT NULL")
        .groupBy("same")
        .agg(
            F.min("doc_id").alias("first"),
            F.min("_key").alias("_key"),
            F.count("*").alias("copies"),
            F.min("n_shingles").alias("n"),
            F.first("sig").alias("sig"),
        )
        .withColumn("rep", F.monotonically_increasing_id()),
        "distinct-sets",
    )
    places = texts.select("rep", F.posexplode_outer(_masked(chunks)("sig")).alias("place", "bucket"))
    buckets = stage(
        places.groupBy("bucket").agg(F.count("*").alias("_m"), F.min("rep").alias("centre")).filter("_m > 1").drop("_m"),
        "buckets",
    )
    found = stage(joined(places, buckets, "bucket", "inner"), "members")
    some = stage(found.select("rep").distinct(), "candidates")
    # Texts of candidates are read again, as shingle sets are larger than texts.
    wanted = stage(joined(texts.select("rep", "_key", "n", "sig"), some, "rep", "left_semi"), "wanted")
    again = joined(docs.select(row_key().alias("_key"), hashed.alias("_h")), wanted.select("_key", "rep"), "_key", "inner")
    sets = stage(
        again.select("rep", _packed("_h").alias("shingles")).dropDuplicates(["rep"]).join(wanted.select("rep", "n", "sig"), "rep"),
        "shingle-sets",
    )
    pairs = stage(found.filter("rep != centre").select("rep", "centre").distinct(), "centre-pairs")
    near = stage(
        _with_centre(pairs, sets, "sig").filter(_apart("sig", "sig2") <= chunks.distance).select("rep", "centre"), "near-pairs"
    )
    links = stage(
        _with_centre(near, sets, "shingles")
        .filter(_similar_pair(percent)("shingles", "shingles2"))
        .select(F.col("rep").alias("src"), F.col("centre").alias("dst")),
        "centre-links",
    )
    label = components(links, some.select(F.col("rep").alias("node")))
    late = _late_links(found, label, sets, percent, chunks, block)
    if late.limit(1).count():
        merged = components(late, label.select(F.col("label").alias("node")).distinct())
        label = stage(
            label.select("node", F.col("label").alias("_l")).join(merged.select(F.col("node").alias("_l"), "label"), "_l").drop("_l"),
            "labels",
        )
    classes = label.join(texts.select(F.col("rep").alias("node"), "first"), "node").groupBy("label").agg(F.min("first").alias("_class"))
    of = label.join(classes, "label").select(F.col("node").alias("rep"), "_class")
    facts = stage(
        texts.join(of, "rep", "left")
        .select("same", "copies", "first", F.coalesce("_class", "first").alias("_class"))
        .filter("copies > 1 OR _class IS DISTINCT FROM first")
        .select("same", "_class", F.lit(True).alias("_linked")),
        "classes",
    )
    discard(buckets, found, some, wanted, sets, pairs, near, links, late, texts)
    component = F.when(F.col("_linked"), F.col("_class")).otherwise(F.col("doc_id"))
    return (
        joined(signed.select("doc_id", "n_shingles", "same"), facts, "same")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
