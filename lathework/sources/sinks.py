"""Writers: sharded files by split, appends by day, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_shards(df: DataFrame, path: str, by: list[str], rows: int = 100_000, fmt: str = "parquet") -> None:
    """Files of at most ``rows`` rows in a folder per value of ``by``; zstd for Parquet. The commit is all or nothing."""
    w = df.write.mode("overwrite").partitionBy(*by).option("maxRecordsPerFile", rows)
    (w.option("compression", "zstd") if fmt == "parquet" else w).format(fmt).save(path)


def write_sized(df: DataFrame, path: str, mb: int = 96) -> None:
    """Files of about ``mb`` MB: AQE merges or splits the rebalanced partitions to that size."""
    spark = df.sparkSession
    key, old = "spark.sql.adaptive.advisoryPartitionSizeInBytes", None
    old = spark.conf.get(key)
    spark.conf.set(key, f"{mb}m")
    try:
        df.hint("rebalance").write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(key, old)


def append_by_day(df: DataFrame, path: str, domain: str, time_col: str) -> None:
    """JSON lines in domain=/day= folders."""
    df.withColumns({"day": F.date_format(time_col, "yyyyMMdd"), "domain": F.col(domain)}).write.mode("append").partitionBy("domain", "day").json(path)


def report_json(df: DataFrame) -> DataFrame:
    """Rows of a small report as JSON texts."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def markdown(df: DataFrame, most: int = 200) -> str:
    """A small report as a Markdown table; more than ``most`` rows is an error, not a cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    line = lambda xs: "| " + " | ".join("" if x is None else str(x).replace("|", "\\|") for x in xs) + " |"
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *[line(r) for r in rows]])
