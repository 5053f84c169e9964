"""Column functions over vectors held as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def length(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where either vector is null or all zeros."""
    n = length(a) * length(b)
    return F.coalesce(F.when(n > 0, dot(a, b) / n), F.lit(0.0))


def unit(a: Column) -> Column:
    """The vector at length one; one of all zeros stays."""
    n = length(a)
    return F.transform(a, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")))


def mean_pool(rows: Column) -> Column:
    """Element-wise mean of an array of vectors of equal size."""
    first = F.transform(F.element_at(rows, 1), lambda x: F.lit(0.0))
    total = F.aggregate(rows, first, lambda s, v: F.zip_with(s, v, lambda x, y: x + y.cast("double")))
    return F.transform(total, lambda x: x / F.size(rows))
