"""Rows that are, or contain, held-out items, by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def bounded(small: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if it has at most ``rows`` rows; else Spark chooses the join."""
    return F.broadcast(small) if small.limit(rows + 1).count() <= rows else small


def decontaminate(df: DataFrame, key: Column, items: DataFrame, item_key: Column) -> DataFrame:
    """Rows whose key equals that of no item."""
    bench = bounded(items.select(item_key.alias("_k")).where("_k <> ''").distinct())
    return df.withColumn("_k", key).join(bench, "_k", "left_anti").drop("_k")


def marked(df: DataFrame, key: Column, items: DataFrame, item_key: Column, out: str) -> DataFrame:
    """All rows, with ``out`` true where the key equals that of an item."""
    bench = bounded(items.select(item_key.alias("_k")).where("_k <> ''").distinct().withColumn("_hit", F.lit(True)))
    return df.withColumn("_k", key).join(bench, "_k", "left").withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_k", "_hit")
