"""Streams over files that arrive, run to their end (``availableNow``) or for ever."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lathework.session import fresh_path


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table's file(s) as a stream; times without zone become times, which watermarks need.

    A single file is watched through its folder by name.
    """
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # the store that holds the table knows, not this machine
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        df = read_stream(spark, path, schema)
    else:
        df = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema if f.dataType.typeName() == "timestamp_ntz"})


def drain(stream: DataFrame, mode: str = "append", name: str = "drain", keys: tuple[str, ...] = ()) -> DataFrame:
    """Run a stream over what is there and give its result as a table in the work folder.

    In complete mode the last batch is the result; in update mode a batch holds only the rows that changed, and the last row of each of
    ``keys`` is.
    """
    if mode == "update" and not keys:
        raise ValueError("update mode needs the keys of a row")
    spark = stream.sparkSession
    out, log = fresh_path(spark, name), fresh_path(spark, name + "-log")
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", log).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)

    def save(df: DataFrame, n: int) -> None:  # each batch replaces the result; a batch that is repeated writes the same
        df.write.mode("overwrite").parquet(f"{out}/batch={n}")

    q = stream.writeStream.outputMode(mode).foreachBatch(save).option("checkpointLocation", log).trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.read.schema(stream.schema.add("batch", "long")).parquet(out) if q.lastProgress else None
    if got is None:
        return spark.createDataFrame([], stream.schema)
    if mode == "update":
        newest = got.groupBy(*keys).agg(F.max_by(F.struct(*stream.columns), "batch").alias("_row"))
        return newest.select("_row.*")
    last = got.agg(F.max("batch")).first()[0]
    return got.where(F.col("batch") == last).drop("batch")


def first_seen(stream: DataFrame, key: list[str], time_col: str, delay: str = "96 hours") -> DataFrame:
    """Rows of keys not seen within the watermark."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, time_col: str, by: list[str], width: str, slide: str | None = None, delay: str = "2 days") -> DataFrame:
    """Rows per window of event time and ``by``; late rows count until the watermark passes."""
    w = F.window(time_col, width, slide) if slide else F.window(time_col, width)
    return stream.withWatermark(time_col, delay).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("w.end").cast("timestamp_ntz").alias("end"), *by, "n")


def sessions(df: DataFrame, time_col: str, by: list[str], gap: str = "30 minutes") -> DataFrame:
    """Sessions of each ``by``: rows less than ``gap`` apart. For tables and streams (with a watermark)."""
    return df.groupBy(F.session_window(time_col, gap).alias("s"), *by).agg(F.count("*").alias("n")).select(*by, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def corroborated(stream: DataFrame, other: DataFrame, key: str, id_col: str, time_col: str, hours: int = 96) -> DataFrame:
    """Rows of two streams of one key within a band of time; both sides forget what the band has passed."""
    a = stream.withWatermark(time_col, f"{hours} hours").select(F.col(id_col).alias("a"), F.col(key).alias("ka"), F.col(time_col).alias("ta"))
    b = other.withWatermark(time_col, f"{hours} hours").select(F.col(id_col).alias("b"), F.col(key).alias("kb"), F.col(time_col).alias("tb"))
    band = F.expr(f"ka = kb and a < b and tb between ta - interval {hours} hours and ta + interval {hours} hours")
    return a.join(b, band).select("a", "b", F.col("ka").alias("key"))


PROFILE = "user long, n long, smoothed double, last string"


def profiles(stream: DataFrame, user: str, value: str, kind: str, time_col: str) -> DataFrame:
    """Per user a running state: rows, the smoothed value (avg + x) / 2 in order of time, and the last kind."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, avg, last = state.get if state.exists else (0, 0.0, None)
        rows = pd.concat(list(frames)).sort_values(["t", "v"], kind="stable")
        for v, k in zip(rows["v"], rows["k"]):
            n, last = n + 1, k
            if v == v:
                avg = (avg + v) / 2
        state.update((n, float(avg), last))
        yield pd.DataFrame({"user": [key[0]], "n": [n], "smoothed": [float(avg)], "last": [last]})

    src = stream.select(F.col(user).cast("long").alias("user"), F.col(value).cast("double").alias("v"), F.col(kind).alias("k"), F.col(time_col).alias("t"))
    return src.groupBy("user").applyInPandasWithState(update, PROFILE, "n long, smoothed double, last string", "update", GroupStateTimeout.NoTimeout)
