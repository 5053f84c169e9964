"""Incremental copies: high-water marks, archives, and pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def after(df: DataFrame, id_col: str, mark: int | None) -> DataFrame:
    """Rows past the mark (all without one); the predicate reaches the scan."""
    return df if mark is None else df.where(F.col(id_col) > mark)


def high_water(df: DataFrame, id_col: str) -> int | None:
    return df.agg(F.max(id_col)).first()[0]


def keep_newest(df: DataFrame, id_col: str, n: int, least: int = 100, most: int = 50_000) -> DataFrame:
    """The ``n`` rows of the largest ids, n held within bounds."""
    n = max(least, min(n, most))
    return df.orderBy(F.desc(id_col)).limit(n)


def archive(df: DataFrame, id_col: str, path: str, mark: int | None) -> tuple[int | None, DataFrame]:
    """Append the rows past the mark to ``path`` and give the new mark with a manifest (rows, max_id, checksum).

    What was written is read back and compared with what was to be written; the mark moves only if both agree. A run
    that dies in between is repeated from the old mark: the write is committed as a whole or not at all.
    """
    new = after(df, id_col, mark)
    facts = [F.count("*").alias("rows"), F.max(id_col).alias("max_id"), F.expr(f"bit_xor(xxhash64({id_col}))").alias("checksum")]
    want = new.agg(*facts).first()
    if not want.rows:
        return mark, df.sparkSession.createDataFrame([(0, mark, None)], "rows long, max_id long, checksum long")
    to = f"{path}/upto={want.max_id}"
    new.write.mode("overwrite").parquet(to)
    got = df.sparkSession.read.parquet(to).agg(*facts).first()
    if got != want:
        raise RuntimeError(f"archive differs: {got} was written, {want} was read")
    return want.max_id, df.sparkSession.createDataFrame([tuple(want)], "rows long, max_id long, checksum long")


def missing_files(spark: SparkSession, best: DataFrame, current: DataFrame, col: str) -> DataFrame:
    """Names of the fuller revision that the current one lacks."""
    return best.select(col).exceptAll(current.select(col)).distinct()


def richest(df: DataFrame, revision: str, item: str) -> DataFrame:
    """The revision with most distinct items; the smaller name of equal ones."""
    per = df.groupBy(revision).agg(F.countDistinct(item).alias("n"))
    return per.orderBy(F.desc("n"), revision).limit(1)
