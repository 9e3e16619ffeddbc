"""Turning array columns into rows.

Catalyst derives a filter on the array from an inner ``explode`` or ``inline`` and pushes it to
the scan, where it computes the whole array expression a second time. The outer forms followed
by a null test compute it once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unroll_structs(rows: DataFrame, keep: list[str], structs: Column | str, first: str) -> DataFrame:
    """One row per struct, its fields as columns; ``first`` is a field that is never null."""
    return rows.select(*keep, F.inline_outer(structs)).filter(F.col(first).isNotNull())


def unroll_values(rows: DataFrame, keep: list[str], values: Column | str, name: str) -> DataFrame:
    """One row per array entry; entries are never null."""
    out = rows.select(*keep, F.explode_outer(values).alias(name))
    return out.filter(F.col(name).isNotNull())
