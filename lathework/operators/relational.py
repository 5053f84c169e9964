"""Joins by time and by range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, take: list[str], left_order: str) -> DataFrame:
    """Each row of ``left`` with the columns ``take`` of the latest row of ``right`` of its key that isn't later.

    Both sides are laid in one order and the last right row is carried forward: one shuffle, no pairs. Of right rows of one
    time the one with the greatest values of ``take`` is carried.
    """
    l = left.select("*", F.lit(1).alias("_side"), F.lit(None).cast(right.select(F.struct(*take).alias("s")).schema["s"].dataType).alias("_r"))
    r = right.select(F.col(key), F.col(time), F.lit(0).alias("_side"), F.struct(*take).alias("_r"))
    w = Window.partitionBy(key).orderBy(time, "_side", F.col("_r").asc_nulls_first(), F.col(left_order).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    got = l.unionByName(r, allowMissingColumns=True).withColumn("_last", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    return got.select(*left.columns, *[F.col(f"_last.{c}").alias(f"asof_{c}") for c in take])


def range_join(points: DataFrame, point: Column, ranges: DataFrame, low: Column, high: Column, width: float) -> DataFrame:
    """Points with the ranges [low, high) they lie in: an equi-join on cells of ``width``, then the exact test.

    Ranges take part once for each cell they touch; ``width`` is best near their usual length.
    """
    p = points.withColumn("_p", point).withColumn("_cell", F.floor(F.col("_p") / width).cast("long"))
    r = ranges.withColumns({"_lo": low, "_hi": high}).withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_lo") / width).cast("long"), F.floor(F.col("_hi") / width).cast("long"))))
    return p.join(r, "_cell").where("_p >= _lo and _p < _hi").drop("_cell", "_p", "_lo", "_hi")
