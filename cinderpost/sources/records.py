"""Quoted CSV files read by many tasks, although records may hold line ends.

A file's splits are scanned as lines. Whether a line ends a record follows from the number of
quotes before it: one count per split and a running sum over splits tell how each split begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderpost.session import ship_package, stage

#: File, first byte of the split, and number in the split of a record: its place among all.
PLACE = ("file", "split_start", "nth")
WHOLE, HEAD, TAIL = 0, 1, 2
_PIECES = "file string, split_start long, nth long, kind int, closed boolean, record string"
_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, split_start, value, quotes`` of every line, in order within a split."""
    scan = spark.read.option("lineSep", "\n").text(path)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return scan.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        "value",
        quotes.alias("quotes"),
    )


def _split_states(lines: DataFrame) -> DataFrame:
    """``file, split_start, opened, open``: whether a split begins and ends inside quotes."""
    sums = lines.groupBy("file", "split_start").agg((F.sum("quotes") % 2).alias("odd"))
    upto = Window.partitionBy("file").orderBy("split_start").rowsBetween(Window.unboundedPreceding, 0)
    ends = sums.withColumn("_ends", F.sum("odd").over(upto) % 2)
    return ends.select(
        "file",
        "split_start",
        ((F.col("_ends") + F.col("odd")) % 2 == 1).alias("opened"),
        (F.col("_ends") == 1).alias("open"),
    )


class _Splitter:
    """Lines of one split, batch by batch, to records and to pieces of records."""

    def __init__(self, file: str, start: int, opened: bool):
        self.place = (file, start)
        self.inside = opened
        self.kind = HEAD if opened else WHOLE
        self.nth = -1 if opened else 0
        self.held: list[str] = []

    def add(self, values: list[str], quotes: np.ndarray) -> Iterator[tuple]:
        ends = np.flatnonzero((np.cumsum(quotes) + self.inside) % 2 == 0)
        at = 0
        for end in ends.tolist():
            if self.held or end > at:
                text = "\n".join([*self.held, *values[at : end + 1]])
                self.held = []
            else:
                text = values[end]
            yield (*self.place, self.nth, self.kind, True, text)
            self.kind, self.nth, at = WHOLE, self.nth + 1, end + 1
        self.held += values[at:]
        self.inside = bool((int(quotes.sum()) + self.inside) % 2)

    def rest(self) -> Iterator[tuple]:
        if self.held:
            kind = HEAD if self.kind == HEAD else TAIL
            yield (*self.place, self.nth, kind, False, "\n".join(self.held))


def _pieces(batches: Iterator[pa.RecordBatch], wanted: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _PIECES.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    current = None
    for batch in batches:
        files, starts, values, quotes, opened = (c.to_pylist() for c in batch.columns)
        quotes, out, at = np.array(quotes, np.int64), [], 0
        while at < len(files):
            place = (files[at], starts[at])
            to = at
            while to < len(files) and (files[to], starts[to]) == place:
                to += 1
            if current is None or current.place != place:
                out += current.rest() if current else ()
                current = _Splitter(*place, opened[at])
            out += current.add(values[at:to], quotes[at:to])
            at = to
        yield packed([r for r in out if r[3] in wanted])
    if current:
        yield packed([r for r in current.rest() if r[3] in wanted])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, split_start, nth, record`` of CSV files: the text of every record, without line end.

    Quotes inside a field are doubled, and a field with quotes, separators or line ends is
    quoted. The order of ``file, split_start, nth`` is that of the records in their files,
    whatever the splits are. Lines end in LF or CRLF; line ends inside quotes stay as they are;
    empty lines are no records. A quote that is never closed takes the rest of its file into one
    record.

    The files are scanned as lines three times: quotes are counted per split, pieces of records
    that cross the ends of splits are put together (two for each split at most), and whole records
    are cut where they lie. No text is shuffled but these pieces.
    """
    ship_package(spark)
    lines = _lines(spark, path)
    states = stage(_split_states(lines), "csv-splits")

    def cut(splits: DataFrame, *wanted: int) -> DataFrame:
        known = lines.join(F.broadcast(splits.select("file", "split_start", "opened")), ["file", "split_start"])
        return known.select("file", "split_start", "value", "quotes", "opened").mapInArrow(
            lambda batches: _pieces(batches, wanted), _PIECES
        )

    pieces = cut(states.filter("opened OR open"), HEAD, TAIL)
    # A record begins with a tail; the heads of the splits that follow belong to it.
    order = Window.partitionBy("file").orderBy("split_start", "nth")
    begun = F.sum((F.col("kind") == TAIL).cast("int")).over(order)
    place = F.struct("split_start", "nth")
    crossing = (
        pieces.withColumn("_record", begun)
        .groupBy("file", "_record")
        .agg(
            F.min(place).alias("_at"),
            F.array_sort(F.collect_list(F.struct("split_start", "nth", "record"))).alias("_parts"),
        )
        .select(
            "file", "_at.split_start", "_at.nth", F.array_join(F.transform("_parts", lambda p: p["record"]), "\n").alias("record")
        )
    )
    # A split that is unknown here was not counted: the settings that cut files have changed.
    unknown = F.raise_error(F.lit("files or the settings that split them changed while they were read"))
    checked = lines.join(F.broadcast(states), ["file", "split_start"], "left").withColumn(
        "opened", F.when(F.col("opened").isNull(), unknown.cast("boolean")).otherwise(F.col("opened"))
    )
    whole = checked.select("file", "split_start", "value", "quotes", "opened").mapInArrow(
        lambda batches: _pieces(batches, (WHOLE,)), _PIECES
    )
    every = whole.select(*PLACE, "record").unionByName(stage(crossing, "csv-crossing"))
    bare = F.regexp_replace("record", "\r$", "")
    return every.select(*PLACE, bare.alias("record")).filter(F.col("record") != "")


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True, places: bool = False
) -> DataFrame:
    """Rows of quoted CSV files by an explicit schema, as Spark's multi-line reader gives them.

    But CRLF inside quotes stays CRLF, where that reader makes it LF. The first record of each file is its header. With ``places`` the columns ``file,
    split_start, nth`` come along, whose order is that of the records.
    """
    records = read_records(spark, path)
    if header:
        # Of a file's first split the first record, which may cross into the next ones.
        records = records.filter((F.col("split_start") > 0) | (F.col("nth") > 0))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    rows = records.withColumn("_row", F.from_csv("record", columns, _OPTIONS))
    return rows.select(*(PLACE if places else ()), *[F.col(f"_row.`{name}`").alias(name) for name in schema.names])
