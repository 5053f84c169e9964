"""Duplicates by a key, and rows that are known already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_best(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """One row per key, the first in ``order``; a null key is a key.

    The best row is an aggregate (the least of its ordering values with its row), so copies are reduced before the
    shuffle and a key that a third of all rows share doesn't land in one task.
    """
    cols = df.columns
    ranked = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"))
    return df.groupBy(key.alias("_key")).agg(F.min(ranked).alias("best")).select("best.row.*")


def drop_empty_keys(df: DataFrame, key: Column) -> DataFrame:
    return df.where(F.coalesce(key, F.lit("")) != "")


def duplicate_report(df: DataFrame, key: Column) -> DataFrame:
    """total, distinct keys, and the difference."""
    per = df.groupBy(key.alias("k")).agg(F.count("*").alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"), F.count("*").alias("distinct_keys")).withColumn("duplicates", F.col("total") - F.col("distinct_keys"))


def first_words(c: Column, n: int = 10) -> Column:
    """The first words, lower-cased."""
    return F.array_join(F.slice(F.filter(F.split(F.lower(F.trim(F.coalesce(c, F.lit("")))), " +"), lambda w: w != ""), 1, n), " ")


def unseen(new: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key isn't among those of ``known``; rows without key are unseen."""
    return new.join(known.select(key).distinct(), key, "left_anti")


def insert_ignore(table: DataFrame, batch: DataFrame, key: str, order: Column) -> DataFrame:
    """The table with the batch's rows of new keys, one (the first in order) per key."""
    fresh = unseen(keep_best(batch, F.col(key), order), table, key)
    return table.unionByName(fresh, allowMissingColumns=True)


def upsert(table: DataFrame, batch: DataFrame, key: str, version: str) -> DataFrame:
    """The latest row of each key by ``version`` (nulls are oldest), the batch's before the table's where equal."""
    both = table.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    best = both.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in both.columns]), F.struct(F.col(version), F.col("_new"))).alias("row"))
    return best.select("row.*").drop("_new")
