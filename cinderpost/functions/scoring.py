"""Score functions shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def threshold(p: Column) -> Column:
    """1 only strictly above one half."""
    return F.when(p > 0.5, 1).otherwise(0)


def checked_label(name: str) -> Column:
    """A label column that fails on anything but 0 and 1, such as the -1 of unmatched posts."""
    label = F.col(name)
    bad = F.raise_error(F.concat(F.lit(f"{name} outside 0/1: "), label.cast("string")))
    return F.when(label.isin(0, 1), label).otherwise(bad.cast("int"))


def first_argmax(scores: Column) -> Column:
    """0-based place of the largest entry; the first of equal ones."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")
