"""Splits, caps and upsampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lathework.functions.scripts import blake_fraction
from lathework.functions.text import unit_fraction


def split_of(key: Column, test: float = 0.01, validation: float = 0.01) -> Column:
    """test, val or train, by the MD5 of the key alone (a hash that SQL has too)."""
    return _split(unit_fraction(key), test, validation)


def split_by_blake2b(key: Column, test: float = 0.01, validation: float = 0.01) -> Column:
    """test, val or train, by the 64-bit BLAKE2b of the key: the split of corpora that were cut with that hash."""
    return _split(blake_fraction(key), test, validation)


def _split(u: Column, test: float, validation: float) -> Column:
    return F.when(u < test, "test").when(u < test + validation, "val").otherwise("train")


def ranked(df: DataFrame, group: str, order: list[str], out: str, spread: int = 64) -> DataFrame:
    """``out``: the place of each row in its group, from 1, over a total order.

    A group may hold a third of all rows: rows are ranked within ranges of the first order column, and the sizes of
    the ranges before (a small table) are added, so a hot group is spread over ``spread`` tasks.
    """
    first = order[0]
    probs = [i / spread for i in range(1, spread)]
    cuts = df.groupBy(group).agg(F.percentile_approx(first, probs, 2000).alias("_cuts"))
    cut = df.join(cuts.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")
    part = cut.withColumn("_part", F.coalesce(F.size(F.filter("_cuts", lambda x: x < F.col(first))), F.lit(0))).drop("_cuts")
    sizes = part.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), F.coalesce("_before", F.lit(0)).alias("_before"))
    got = part.join(before, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p"))).drop("_g", "_p")
    place = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order))
    return got.withColumn(out, (F.col("_before") + place).cast("long")).drop("_part", "_before")


def cap_and_repeat(df: DataFrame, group: str, order: list[str], cap: int, repeats: dict[str, int]) -> DataFrame:
    """At most ``cap`` rows per group, rows of the groups in ``repeats`` given that many times, first come first served.

    The last row taken may get fewer copies than its group's number. Adds ``copy`` (from 1).
    """
    times = F.lit(1)
    for g, n in repeats.items():
        times = F.when(F.col(group) == g, F.lit(n)).otherwise(times)
    r = ranked(df, group, order, "_r").withColumn("_t", times)
    copies = F.greatest(F.lit(0), F.least(F.col("_t").cast("long"), F.lit(cap) - (F.col("_r") - 1) * F.col("_t")))
    return r.withColumn("_n", copies.cast("int")).where("_n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_r", "_t", "_n")


def cap_with_exempt(df: DataFrame, group: str, order: list[str], cap: int, exempt: list[str], total: int) -> DataFrame:
    """At most ``cap`` rows of each group but the exempt ones, then the first ``total`` of what is left."""
    kept = ranked(df, group, order, "_r").where((F.col("_r") <= cap) | F.col(group).isin(exempt)).drop("_r")
    return kept.orderBy(*order).limit(total)


def hash_sample(df: DataFrame, key: Column, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows, always the same for a seed: those whose key has the least hash."""
    return df.withColumn("_h", F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))).orderBy("_h", key).limit(n).drop("_h")
