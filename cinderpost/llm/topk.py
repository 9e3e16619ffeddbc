"""Exact top-k by inner product: norm buckets, pruned by local cosine thresholds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderpost.session import ship_package, stage

SCALE = 1024
RATIO = 1.05
BUCKET_ROWS = 4096
QUERY_ROWS = 1024
FOCUS = 4
STEEP = 0.9

PACK = "row binary, id binary, known binary, norm binary, matrix binary, width int, n int, dim int"


def quantized(vector: str) -> Column:
    """floor(1024 * x) of every component; null if the vector or a component isn't finite."""
    x = F.col(vector)
    finite = F.forall(
        x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))
    )
    return F.when(finite, F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("long")))


def _pack(rows: pd.DataFrame) -> dict:
    """Vectors, longest first, as plain arrays of the least width; shorter vectors end in zeros."""
    rows = rows.sort_values(["norm", "uid"], ascending=[False, True])
    dim = max((len(v) for v in rows["v"]), default=0)
    matrix = np.zeros((len(rows), dim), np.int64)
    for i, v in enumerate(rows["v"]):
        matrix[i, : len(v)] = v
    width = next(w for w in (2, 4, 8) if matrix.size == 0 or -(1 << 8 * w - 1) <= matrix.min() and matrix.max() < 1 << 8 * w - 1)
    known = rows["id"].notna().to_numpy()
    return {
        "row": rows["uid"].to_numpy(np.int64).tobytes(),
        "id": rows["id"].fillna(0).to_numpy(np.int64).tobytes(),
        "known": known.tobytes(),
        "norm": rows["norm"].to_numpy(np.float64).tobytes(),
        "matrix": matrix.astype(f"i{width}").tobytes(),
        "width": width,
        "n": len(rows),
        "dim": dim,
    }


class _Block:
    """A packed block, read back."""

    def __init__(self, r, prefix: str = "") -> None:
        get = lambda name: getattr(r, prefix + name)
        self.n, self.dim = get("n"), get("dim")
        self.row = np.frombuffer(get("row"), np.int64)
        self.known = np.frombuffer(get("known"), bool)
        self.id = np.where(self.known, np.frombuffer(get("id"), np.int64), np.iinfo(np.int64).max)
        self.norm = np.frombuffer(get("norm"), np.float64)
        self.matrix = np.frombuffer(get("matrix"), f"i{get('width')}").astype(np.int64).reshape(self.n, self.dim)


def _candidates(query: np.ndarray, norm: float, bucket: _Block, unit: np.ndarray, least: float) -> np.ndarray:
    """Rows of a bucket that may reach the score ``least``.

    The local threshold is the cosine that the longest vector of the bucket would need. Above
    STEEP, coordinates prune: with cosine c the query's largest components f leave a vector's
    component only between cos(acos(f) +- acos(c)). Below, lengths do: the rows whose length
    times the query's reaches the score come first in the bucket.
    """
    if not np.isfinite(least) or least <= 0 or norm == 0 or bucket.n == 0 or bucket.norm[0] == 0:
        return np.arange(bucket.n)
    # One part in 10^9 is left for rounding.
    cosine = least / (norm * bucket.norm[0]) * (1 - 1e-9)
    if cosine > 1:
        return np.empty(0, np.int64)
    if cosine < STEEP:
        return np.arange(np.searchsorted(-bucket.norm, -(least / norm) * (1 - 1e-9), side="right"))
    rows, spread = np.arange(bucket.n), np.arccos(cosine)
    direction = query / norm
    for f in np.argsort(-np.abs(direction))[:FOCUS]:
        if f < bucket.dim:
            angle = np.arccos(np.clip(direction[f], -1, 1))
            lo, hi = np.cos(min(np.pi, angle + spread)), np.cos(max(0.0, angle - spread))
            values = unit[rows, f]
            rows = rows[(values >= lo - 1e-9) & (values <= hi + 1e-9)]
    return rows


def _long_products(matrix: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Products of any size; one that a long can't hold is an error, never a wrong number."""
    scores = matrix.astype(object) @ query.astype(object)
    if any(not -(1 << 63) <= x < 1 << 63 for x in scores):
        raise OverflowError("an inner product is beyond 64 bits")
    return scores.astype(np.int64)


def _best(queries: _Block, bucket: _Block, least: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its k best rows of the bucket: position of the query, rows, scores."""
    unit = bucket.matrix / np.where(bucket.norm > 0, bucket.norm, 1)[:, None]
    exact = bucket.matrix.astype(np.float64)
    for i in range(queries.n):
        q, norm = queries.matrix[i], queries.norm[i]
        rows = _candidates(q, norm, bucket, unit, least[i])
        rows = rows[bucket.row[rows] != queries.row[i]]
        if not len(rows):
            continue
        d = min(queries.dim, bucket.dim)
        if norm * bucket.norm[0] < 2**52:  # then floats carry the integers exactly
            scores = (exact[rows, :d] @ q[:d].astype(np.float64)).astype(np.int64)
        elif norm * bucket.norm[0] < 2**62:
            scores = bucket.matrix[rows, :d] @ q[:d]
        else:
            scores = _long_products(bucket.matrix[rows, :d], q[:d])
        keep = scores >= least[i]
        rows, scores = rows[keep], scores[keep]
        top = np.lexsort((bucket.id[rows], -scores))[:k]
        yield i, rows[top], scores[top]


def top_k(
    vectors: DataFrame,
    queries: Column,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    k: int = 10,
    bucket_rows: int = BUCKET_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer products of every query row.

    ``queries`` is a condition on the rows of ``vectors``; every other row is a candidate.
    Vectors are grouped by length into classes of ratio 1.05, classes are dealt into buckets of
    about ``bucket_rows`` vectors by a hash, so a class or a single vector of any share is
    spread evenly. Queries are dealt into blocks. A bucket of long vectors gives every query a
    first k-th score; a block then visits only the buckets whose longest vector can reach the
    lowest of these, prunes inside, and verifies what is left with exact integers.

    Buckets are shuffled once; the blocks that visit a bucket follow it there. One task holds one
    bucket and one block. A score beyond 64 bits is an error. Ties go to the smaller id, null ids last. Null,
    NaN and infinite vectors take no part; shorter vectors count as ending in zeros. A row is
    never its own candidate, another row with its id is. Extra columns are ignored.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    level = F.when(F.col("norm") > 0, F.floor(F.log("norm") / F.log(F.lit(RATIO))).cast("int"))
    usable = stage(
        vectors.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col(vec_id).cast("long").alias("id"),
            quantized(vector).alias("v"),
            F.coalesce(queries, F.lit(False)).alias("asked"),
        )
        .filter("v IS NOT NULL")
        .withColumn("norm", norm)
        .withColumn("level", F.coalesce(level, F.lit(-1))),
        "vectors",
    )
    # One row per class of length: at most a few thousand, by the range of numbers.
    classes = usable.groupBy("level").agg(F.count("*").alias("m")).orderBy(F.desc("level")).collect()
    asked = usable.filter("asked").count()
    names = "query_id long, rank int, vec_id long, score long"
    if not classes or not asked:
        return spark.createDataFrame([], names)
    counts = spark.createDataFrame(classes, "level int, m long")
    parts = F.ceil(F.col("m") / bucket_rows)
    dealt = usable.join(F.broadcast(counts), "level").select(
        "level", F.pmod(F.xxhash64("uid"), parts).cast("int").alias("part"), "uid", "id", "norm", "v"
    )

    def bucket(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"level": key[0], "part": key[1], "longest": rows["norm"].max(), **_pack(rows)}])

    buckets = stage(
        dealt.groupBy("level", "part").applyInPandas(bucket, f"level int, part int, longest double, {PACK}"),
        "buckets",
    )
    blocks_of = max(1, -(-asked // query_rows))

    def block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"block": key[0], **_pack(rows)}])

    blocks = stage(
        usable.filter("asked")
        .select(F.pmod(F.xxhash64("uid", F.lit(3)), F.lit(blocks_of)).cast("int").alias("block"), "uid", "id", "norm", "v")
        .groupBy("block")
        .applyInPandas(block, f"block int, {PACK}"),
        "query-blocks",
    )
    seed = next((c["level"] for c in classes if c["m"] > 4 * k), classes[0]["level"])
    first = buckets.filter((F.col("level") == seed) & (F.col("part") == 0))
    renamed = {c.split()[0]: f"b_{c.split()[0]}" for c in PACK.split(", ")}
    opened = blocks.withColumns({"level": F.lit(seed), "part": F.lit(0)}).join(
        first.withColumnsRenamed(renamed), ["level", "part"], "left"
    )

    def thresholds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                asking = _Block(r)
                least = np.full(asking.n, -np.inf)
                if r.b_row is not None:
                    for i, _, scores in _best(asking, _Block(r, "b_"), least.copy(), k):
                        if len(scores) == k:
                            least[i] = scores[-1]
                with np.errstate(divide="ignore", invalid="ignore"):
                    reach = np.where((least > 0) & (asking.norm > 0), least / asking.norm, 0.0)
                out.append((r.block, least.tobytes(), float(reach.min()) * (1 - 1e-9)))
            yield pd.DataFrame(out, columns=["block", "least", "reach"])

    limits = stage(opened.mapInPandas(thresholds, "block int, least binary, reach double"), "thresholds")
    pairs = stage(
        limits.select("block", "reach", F.explode_outer(F.array(*[F.lit(c["level"]) for c in classes])).alias("level"))
        .filter(F.pow(F.lit(RATIO), F.col("level") + 1) * (1 + 1e-9) >= F.col("reach"))
        .join(buckets.select("level", "part", "longest"), "level")
        .filter(F.col("longest") >= F.col("reach"))
        .select("block", "level", "part"),
        "pairs",
    )
    visits = pairs.join(blocks.join(limits.select("block", "least"), "block"), "block").withColumn("_second", F.lit(True))
    visited = buckets.drop("longest").withColumns(
        {"block": F.lit(-1), "least": F.lit(None).cast("binary"), "_second": F.lit(False)}
    )
    shipped = ["level", "part", "_second", "block", "least", *renamed]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            for r in batch.itertuples(index=False, name="Visit"):
                if r.block < 0:
                    held = _Block(r)
                    continue
                asking, least, out = _Block(r), np.frombuffer(r.least, np.float64), []
                for i, rows, scores in _best(asking, held, least, k):
                    out.append(
                        pd.DataFrame(
                            {
                                "uid": asking.row[i],
                                "query_id": asking.id[i],
                                "vec_id": pd.array(held.id[rows], "Int64"),
                                "known": held.known[rows],
                                "score": scores,
                            }
                        )
                    )
                if out:
                    yield pd.concat(out)

    found = (
        visits.select(shipped)
        .unionByName(visited.select(shipped))
        .repartition("level", "part")
        .sortWithinPartitions("level", "part", "_second")
        .drop("_second")
        .mapInPandas(verify, "uid long, query_id long, vec_id long, known boolean, score long")
    )
    order = Window.partitionBy("uid").orderBy(F.desc("score"), F.col("vec_id").asc())
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.when(F.col("known"), F.col("vec_id")).alias("vec_id"), "score")
    )
