"""Rows packed by feature, for sums over all of them again and again.

A block holds whole features: the places of their posts and the values under every weighting, as
arrays. A pass takes numbers by post to the features and back in one step, since a feature's rows
lie together; what tasks have found for the posts is added up. Numbers by post are cut into groups
of units that fit the broadcast size, so that no task and no driver holds more.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinderpost.session import discard, stage

# Rows of a block, starting weights of a block, bytes of a piece of numbers by post, and bytes of
# shuffled sums after which the driver lets go of their files and of its own garbage.
ROWS = 1 << 18
WEIGHTS = 1 << 19
PIECE = 4 << 20
SHUFFLED = 64 << 20
# Bytes of blocks that a task is handed at once.
BATCH = 8 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, tasks are handed few blocks at once; Spark's own limit is 64 MB."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class _Packer:
    """Sorted rows, feature by feature, to blocks; features without a training row are left out."""

    def __init__(self, weightings: int, units: int):
        self.weightings, self.units = weightings, units
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple] = []
        self.rows = self.features = 0

    def full(self) -> bool:
        return self.rows >= ROWS or self.features * self.units >= WEIGHTS

    def add(self, batch: pa.RecordBatch, first: np.ndarray) -> None:
        if batch.num_rows:
            self.parts.append((batch, first))
            self.rows += batch.num_rows
            self.features += int(first.sum())

    def block(self) -> pa.RecordBatch | None:
        if not self.parts:
            return None
        table = pa.Table.from_batches([b for b, _ in self.parts]).combine_chunks()
        first = np.concatenate([f for _, f in self.parts])
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(first)))
        known = np.logical_or.reduceat(table["trains"].to_numpy(), starts)
        kept, n = np.repeat(known, sizes), int(known.sum())
        self.clear()
        if not n:
            return None
        flat = lambda name, width: table[name].combine_chunks().flatten().fill_null(0.0).to_numpy().reshape(-1, width)
        values = np.ascontiguousarray(flat("v", self.weightings)[kept].T)
        begin = np.ascontiguousarray(flat("w", self.units)[known].T)
        names = table["feature"].combine_chunks().filter(pa.array(first)).filter(pa.array(known))
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), names),
                pa.array([sizes[known].astype(np.int32).tobytes()], pa.binary()),
                pa.array([table["place"].to_numpy()[kept].astype(np.int32).tobytes()], pa.binary()),
                pa.array([[x.tobytes() for x in values]], pa.list_(pa.binary())),
                pa.array([[x.tobytes() for x in begin]], pa.list_(pa.binary())),
            ],
            names=["names", "sizes", "places", "v", "w"],
        )


PACKED = "names array<string>, sizes binary, places binary, v array<binary>, w array<binary>"


def pack(placed: DataFrame, start: Column, weightings: int, units: int) -> DataFrame:
    """Written blocks of ``place, trains, feature, v``, with the starting weights of ``units``."""
    spark = placed.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    values = F.array(*[F.coalesce(F.get("v", F.lit(r)), F.lit(0.0)) for r in range(weightings)]).alias("v")
    trains = F.coalesce("trains", F.lit(False)).alias("trains")
    rows = placed.select("feature", "place", trains, values).repartition(parts, "feature")
    number = F.row_number().over(Window.partitionBy("feature").orderBy("place"))
    # Names and weights are given once for a feature, in its first row.
    first = lambda value: F.when(F.col("_n") == 1, value)
    rows = rows.withColumn("_n", number).withColumn("w", first(start)).withColumn("feature", first(F.col("feature"))).drop("_n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(weightings, units)
        for batch in batches:
            first = batch.column("w").is_valid().to_numpy(zero_copy_only=False)
            if packer.full() and first.any():
                cut = int(first.argmax())
                packer.add(batch.slice(0, cut), first[:cut])
                if (block := packer.block()) is not None:
                    yield block
                batch, first = batch.slice(cut), first[cut:]
            packer.add(batch, first)
        if (block := packer.block()) is not None:
            yield block
        pa.default_memory_pool().release_unused()

    return stage(rows.mapInArrow(run, PACKED), "blocks")


def _slopes_of(sizes: np.ndarray, places: np.ndarray, value: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Per feature the sum of its rows times the number of their post."""
    return np.add.reduceat(back.take(places) * value, np.cumsum(sizes) - sizes)


def _matrix(values: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(x) for x in values]


@dataclass
class Blocks:
    """Packed rows of ``n`` posts; ``values`` tells the weighting of every unit."""

    table: DataFrame
    n: int
    values: list[int]
    limit: int

    def __post_init__(self):
        # Half of the limit, as the driver holds what comes and what goes.
        each = max(1, self.limit // max(1, 16 * self.n))
        self.shuffled = 0
        self.groups = [slice(a, min(a + each, len(self.values))) for a in range(0, len(self.values), each)]

    def used(self, group: slice) -> tuple[list[int], Column]:
        """Of every unit the place of its weighting among those that the group uses; their values."""
        own = sorted(set(self.values[group]))
        return [own.index(r) for r in self.values[group]], F.array(*[F.get("v", F.lit(r)) for r in own]).alias("v")

    def sums(self, back: Broadcast | None, group: slice) -> np.ndarray:
        """By unit of the group and post, the sum of the post's rows times their feature's number.

        That number is the feature's sum of rows times ``back`` (units by posts), or, without it,
        the starting weight.
        """
        (values, v_used), n, size = self.used(group), self.n, group.stop - group.start
        own = F.slice("w", group.start + 1, size).alias("w") if back is None else F.lit(None).cast("array<binary>").alias("w")
        step = max(1, PIECE // (8 * size))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # A view of plain doubles: the kind that comes unpickled is added twenty times slower.
            total, numbers = None, None if back is None else back.value.view(np.float64)
            for batch in batches:
                columns = [batch.column(c) for c in ("sizes", "places", "v", "w")]
                for i in range(batch.num_rows):  # one block at a time
                    total = np.zeros((size, n)) if total is None else total
                    sizes, places = (np.frombuffer(c[i].as_py(), np.int32) for c in columns[:2])
                    v, w = _matrix(columns[2][i].as_py()), columns[3][i].as_py()
                    places = places.astype(np.intp)
                    for u, r in enumerate(values):
                        by_feature = np.frombuffer(w[u]) if back is None else _slopes_of(sizes, places, v[r], numbers[u])
                        np.add.at(total[u], places, np.repeat(by_feature, sizes) * v[r])
            if total is not None:
                task = TaskContext.get().partitionId()
                for k, at in enumerate(range(0, n, step)):
                    piece = [pa.array([k], pa.int32()), pa.array([task], pa.int32()), pa.array([total[:, at : at + step].tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(piece, names=["piece", "task", "x"])
            pa.default_memory_pool().release_unused()

        # One task a core: each gives numbers for all posts.
        context = self.table.sparkSession.sparkContext
        tasks = self.table.select("sizes", "places", v_used, own).coalesce(context.defaultParallelism)
        found, sent = tasks.mapInArrow(run, "piece int, task int, x binary"), 8 * n * size * context.defaultParallelism
        if 4 * sent > self.limit:
            self.shuffled += sent

            def added(piece: pd.DataFrame) -> pd.DataFrame:
                piece = piece.sort_values("task")
                total = np.frombuffer(piece["x"].iloc[0]).copy()
                for x in piece["x"].iloc[1:]:
                    total += np.frombuffer(x)
                return pd.DataFrame({"piece": piece["piece"].iloc[:1], "task": [0], "x": [total.tobytes()]})

            found = found.groupBy("piece").applyInPandas(added, "piece int, task int, x binary")
        out = np.zeros((size, n))
        with small_batches(self.table.sparkSession):
            rows = found.collect()  # as many numbers as half the broadcast size holds
        for r in rows:
            at = slice(r["piece"] * step, min(n, (r["piece"] + 1) * step))
            out[:, at] += np.frombuffer(r["x"]).reshape(size, -1)
        if self.shuffled > SHUFFLED:
            # Shuffle files stay until the driver's garbage is collected, which takes many passes.
            del found
            context._jvm.System.gc()
            self.shuffled = 0
        return out

    def weights(self, back: Broadcast, group: slice) -> DataFrame:
        """``feature, w``: the starting weights of the group and what the posts add to them."""
        (values, v_used), size = self.used(group), group.stop - group.start

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers = back.value.view(np.float64)
            for batch in batches:
                columns = [batch.column(c) for c in ("names", "sizes", "places", "v", "w")]
                for i in range(batch.num_rows):
                    names = columns[0][i].values
                    sizes, places = (np.frombuffer(c[i].as_py(), np.int32) for c in columns[1:3])
                    v, w = (_matrix(c[i].as_py()) for c in columns[3:])
                    found = np.empty((len(names), size))
                    for u, r in enumerate(values):
                        found[:, u] = w[u] + _slopes_of(sizes, places, v[r], numbers[u])
                    ends = pa.array(np.arange(len(names) + 1, dtype=np.int32) * size)
                    rows = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
                    yield pa.RecordBatch.from_arrays([names, rows], names=["feature", "w"])
            pa.default_memory_pool().release_unused()

        own = F.slice("w", group.start + 1, size).alias("w")
        return self.table.select("names", "sizes", "places", v_used, own).mapInArrow(run, "feature string, w array<double>")

    def discard(self) -> None:
        discard(self.table)


def gathered(posts: DataFrame, column: str, group: slice, width: int, n: int) -> np.ndarray:
    """Numbers of a group of units of the posts that train, by unit and place; 0 for the others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                own = np.frombuffer(b"".join(batch[column])).reshape(-1, width)[:, group]
                yield pd.DataFrame({"id": [batch["id"].to_numpy(np.int32).tobytes()], "x": [own.tobytes()]})

    out = np.zeros((group.stop - group.start, n))
    parts = posts.filter("trains").select("id", column).mapInPandas(run, "id binary, x binary")
    for r in parts.collect():  # as many numbers as the broadcast size holds
        out[:, np.frombuffer(r["id"], np.int32)] = np.frombuffer(r["x"]).reshape(-1, len(out)).T
    return out


@dataclass
class ByPost:
    """Numbers by place, sent to all tasks in pieces, of which a task reads those of its posts."""

    step: int
    widths: list[int]
    pieces: list[list[Broadcast]]

    @staticmethod
    def sent(context, groups: Iterator[np.ndarray], width: int) -> ByPost:
        step = max(1, PIECE // (8 * width))
        widths, pieces = [], []
        for x in groups:
            widths.append(len(x))
            pieces.append([context.broadcast(np.ascontiguousarray(x[:, i : i + step].T)) for i in range(0, x.shape[1], step)])
        return ByPost(step, widths, pieces)

    def of(self, places: np.ndarray) -> np.ndarray:
        """A row of all units for every place."""
        pieces = places // self.step
        columns = []
        for size, group in zip(self.widths, self.pieces):
            found = np.empty((len(places), size))
            for k in np.unique(pieces):
                here = pieces == k
                found[here] = group[k].value[places[here] - k * self.step]
            columns.append(found)
        return np.hstack(columns)

    def destroy(self) -> None:
        for group in self.pieces:
            for piece in group:
                piece.destroy()
