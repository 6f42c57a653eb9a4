"""Element-wise and reducing expressions over array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    """Sum of element products, in double."""
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def compare(a: Column, b: Column, test: Callable[[Column, Column], Column]) -> Column:
    """Array of booleans, one per pair of elements."""
    return F.zip_with(a, b, test)


def argmax(a: Column) -> Column:
    """Position of the first largest element, from 0."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("bigint")


def argmin(a: Column) -> Column:
    return (F.array_position(a, F.array_min(a)) - 1).cast("bigint")


def argsort(a: Column) -> Column:
    """Positions, from 0, in ascending order of the elements."""
    keyed = F.transform(a, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    return F.transform(F.array_sort(keyed), lambda p: p["i"].cast("bigint"))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def relu(x: Column) -> Column:
    return F.greatest(F.lit(0.0), x)


def softmax(a: Column) -> Column:
    """Probabilities of an array of scores; the largest is taken off first."""
    raised = F.transform(a, lambda x: F.exp(x.cast("double") - F.array_max(a).cast("double")))
    return F.transform(raised, lambda e: e / total(raised))
