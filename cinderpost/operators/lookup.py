"""Joining a long, skewed table to a table with one row per key."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderpost.session import bucketed_stage, discard, stage

BROADCAST_BYTES = 48 << 20
HOT_KEYS = 4096


def _fixed_bytes(kind: T.DataType) -> int | None:
    """Bytes of a value whose type alone tells its size."""
    if isinstance(kind, T.StructType):
        fields = [_fixed_bytes(f.dataType) for f in kind.fields]
        return None if None in fields else 8 + sum(fields)
    if isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.UserDefinedType, T.VariantType)):
        return None
    return 24 if isinstance(kind, T.DecimalType) and kind.precision > 18 else 8


def _bytes_of(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value, whatever is nested in it; 8 for the place of a null one."""
    fixed = _fixed_bytes(kind)
    if fixed is not None:
        return F.lit(fixed).cast("long")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value) + 16
    elif isinstance(kind, T.StructType):
        size = F.lit(8)
        for f in kind.fields:
            size = size + _bytes_of(value[f.name], f.dataType)
    elif isinstance(kind, T.ArrayType):
        each = _fixed_bytes(kind.elementType)
        size = 24 + (
            F.size(value) * each
            if each is not None
            else F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + _bytes_of(x, kind.elementType))
        )
    elif isinstance(kind, T.MapType):
        keys, values = T.ArrayType(kind.keyType), T.ArrayType(kind.valueType)
        size = _bytes_of(F.map_keys(value), keys) + _bytes_of(F.map_values(value), values)
    else:
        size = F.octet_length(F.to_json(F.struct(value)))
    return F.coalesce(size.cast("long"), F.lit(8).cast("long"))


def _row_bytes(table: DataFrame) -> Column:
    """Size of a row in memory: all fields, what is nested in them, a row overhead."""
    size = F.lit(64).cast("long")
    for f in table.schema.fields:
        size = size + _bytes_of(F.col(f"`{f.name}`"), f.dataType)
    return size


def measured_bytes(table: DataFrame) -> int:
    """Size of a table in memory, counted."""
    return table.agg(F.coalesce(F.sum(_row_bytes(table)), F.lit(0)).alias("b")).first()["b"]


def well_supported(table: DataFrame, key: str, support: str, size: Column, budget: int) -> DataFrame:
    """Keys whose entries fit ``budget`` bytes together, the ones of most ``support`` first.

    Keys that hold at least 1/HOT_KEYS of all support are always among them. ``size`` is the bytes
    of an entry; the driver reads one row per class of support, eight classes to a doubling.
    """
    classed = F.floor(F.log2(F.greatest(F.col(support), F.lit(1))) * 8).cast("int")
    classes = table.groupBy(classed.alias("_c")).agg(F.sum(size).alias("_b"), F.sum(support).alias("_n")).collect()
    total, taken, least = sum(r["_n"] or 0 for r in classes), 0, None
    for r in sorted(classes, key=lambda r: -r["_c"]):
        taken += r["_b"]
        if taken > budget:
            break
        least = r["_c"]
    hot = F.col(support) * HOT_KEYS >= total
    return table.filter(hot if least is None else hot | (classed >= least)).select(key)


def hot_keys(rows: DataFrame, key: str, size: Column | None = None, budget: int = 0) -> DataFrame:
    """Keys of ``rows`` that ``well_supported`` finds, by one pass over them."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    return well_supported(stage(counts, "key-counts"), key, "_n", F.lit(1) if size is None else size, budget)


def keyed_lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    how: str = "left",
    support: str | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Join ``rows`` to ``table`` (a written stage, one row per ``key``), left or inner.

    A table measured small is broadcast. Beyond that, the entries of the most frequent keys, as
    many as half of that size holds, are broadcast and their rows, by far the larger part of a
    text's words, never leave their task; only the rows of the other keys are shuffled. Rows without a
    key match nothing, so a left join keeps them where they are and an inner one drops them
    first. ``rows`` is read once for each part, so it should start from a written stage.

    ``support`` names a column of ``table`` that counts the key's rows in the data the table
    was made from; it tells the hot keys without a pass over ``rows`` and is not returned. A
    key that is hot only in ``rows`` is left to Spark's own skew-join splitting.
    """
    values = [c for c in table.columns if c not in (key, support)]
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    entry = table.select(key, *values)
    in_all, n = entry.agg(F.coalesce(F.sum(_row_bytes(entry)), F.lit(0)), F.count("*")).first()
    if in_all <= limit:
        return rows.join(F.broadcast(entry), key, how)
    if support:
        frequent = well_supported(table, key, support, _row_bytes(entry), limit // 2)
    else:
        frequent = hot_keys(rows, key, F.lit(-(-in_all // n)), limit // 2)
    keys = stage(frequent, "hot-keys")
    entries = table.join(F.broadcast(keys), key, "left_semi").select(key, *values)
    if how == "left":
        # A hot key without an entry must not reach the shuffle either.
        entries = keys.join(F.broadcast(entries), key, "left")
    hot = rows.join(F.broadcast(entries), key)
    keyed = rows.filter(F.col(key).isNotNull())
    cold = keyed.join(F.broadcast(keys), key, "left_anti").join(table.select(key, *values), key, how)
    if how == "left":
        kinds = {f.name: f.dataType for f in table.schema.fields}
        unkeyed = rows.filter(F.col(key).isNull())
        cold = cold.unionByName(unkeyed.withColumns({c: F.lit(None).cast(kinds[c]) for c in values}))
    return hot.unionByName(cold)


@dataclass
class PlacedRows:
    """Rows that are summed again and again with a table that changes: by post and by feature.

    ``by_post`` is bucketed by the post. When a table of all features is too large to broadcast,
    the features of ``hot`` are known, and ``rare``, bucketed by the feature, holds the rows of
    all others; both are made once. ``counts`` has every feature and the number ``n`` of its rows.
    """

    by_post: DataFrame
    labels: DataFrame
    post: str
    hot: DataFrame | None = None
    rare: DataFrame | None = None
    counts: DataFrame | None = None

    def sums(self, table: DataFrame, key: str, sums: list[Column]) -> DataFrame:
        """``sums`` (aliased) per post over its rows with their entry of ``table``."""
        if self.rare is None:
            return self.by_post.join(F.broadcast(table), key, "left").groupBy(self.post).agg(*sums)
        # Hot features stay with their posts. Rare ones meet the table where they lie by
        # feature; what they add up to, one row per post and task, is all that is shuffled.
        entries = self.hot.join(F.broadcast(table.join(F.broadcast(self.hot), key, "left_semi")), key, "left")
        near = self.by_post.join(F.broadcast(entries), key).groupBy(self.post).agg(*sums)
        far = self.rare.join(table, key, "left").groupBy(self.post).agg(*sums)
        names = [c for c in near.columns if c != self.post]
        return near.unionByName(far).groupBy(self.post).agg(*[F.sum(c).alias(c) for c in names])


def hot_features(counts: DataFrame, key: str, width: int, broadcast_bytes: int | None = None) -> DataFrame | None:
    """Written keys to broadcast of ``counts`` (``n`` rows a key); none if all of them can be.

    The entries to come hold ``width`` numbers, from which their size is known.
    """
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    entry = _row_bytes(counts) + 8 * width
    if counts.agg(F.coalesce(F.sum(entry), F.lit(0))).first()[0] <= limit:
        return None
    return stage(well_supported(counts, key, "n", entry, limit // 2), "hot-keys")


@contextmanager
def placed_rows(
    rows: DataFrame,
    post: str,
    key: str,
    label: str,
    bias: str,
    width: int,
    broadcast_bytes: int | None = None,
) -> Iterator[PlacedRows]:
    """Lay out written rows once for many rounds; every post has one row of feature ``bias``.

    The tables to come hold ``width`` numbers per feature, from which their size is known.
    """
    with bucketed_stage(rows, "by_post", post) as by_post:
        labels = stage(by_post.filter(F.col(key) == bias).select(post, label), "labels")
        counts = stage(by_post.groupBy(key).agg(F.count("*").alias("n")), "feature-counts")
        hot = hot_features(counts, key, width, broadcast_bytes)
        if hot is None:
            yield PlacedRows(by_post, labels, post, counts=counts)
        else:
            cold = by_post.join(F.broadcast(hot), key, "left_anti")
            with bucketed_stage(cold, "by_feature", key) as rare:
                yield PlacedRows(by_post, labels, post, hot, rare, counts)
            discard(hot)
        discard(labels, counts)
