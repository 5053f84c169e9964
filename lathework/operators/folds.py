"""Ordered folds: state that depends on all rows before, of the same key."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lathework.session import fresh_path


def smoothed(df: DataFrame, key: str, order: list[str], value: str, start: float = 0.0) -> DataFrame:
    """(key, n, smoothed): avg = (avg + x) / 2 over the rows in order. Only the last 1,100 values
    are folded: each halves what came before, so earlier ones add nothing to a double."""
    df = keep_last(df.where(F.col(value).isNotNull()).withColumn("_n", F.count(value).over(Window.partitionBy(key))), key, order, 1100)
    pairs = F.struct(*[F.col(o) for o in order], F.col(value).cast("double").alias("_v"))
    got = df.groupBy(key).agg(F.first("_n").alias("n"), F.array_sort(F.collect_list(pairs)).alias("s"))
    v = F.aggregate("s", F.lit(start), lambda acc, x: (acc + x["_v"]) / 2)
    return got.select(key, "n", F.round(v, 9).alias("smoothed"))


def rolling_by_level(df: DataFrame, key: str, order: list[str], value: str, level: str, rows: int) -> DataFrame:
    """Adds ``rolling``: the mean of the last ``rows`` values since the level last changed."""
    w = Window.partitionBy(key).orderBy(*order)
    run = F.sum(F.when(F.col(level).eqNullSafe(F.lag(level).over(w)), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("_run", run).withColumn("rolling", F.round(F.avg(value).over(Window.partitionBy(key, "_run").orderBy(*order).rowsBetween(-(rows - 1), 0)), 6)).drop("_run")


def keep_last(df: DataFrame, key: str, order: list[str], k: int) -> DataFrame:
    """The last ``k`` rows of each key."""
    desc = [F.desc(o) for o in order]
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*desc))).where(F.col("_r") <= k).drop("_r")


def collapse_runs(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Without rows whose value repeats that of the row before."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_p", F.lag(value).over(w)).withColumn("_f", F.row_number().over(w)).where((F.col("_f") == 1) | ~F.col(value).eqNullSafe(F.col("_p"))).drop("_p", "_f")


def folded(df: DataFrame, key: str, schema: str, fold: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """A fold that no expression can state, once per key; for keys of bounded size (users, subjects, players)."""
    return df.groupBy(key).applyInPandas(fold, schema)


def elo(df: DataFrame, key: str, order: list[str], won: str, opponent: str, k: float = 32.0, start: float = 1000.0) -> DataFrame:
    """(key, games, rating): the rating after all games of each player against opponents of given ratings."""
    games = F.array_sort(F.collect_list(F.struct(*[F.col(o) for o in order], F.col(won).cast("double").alias("_w"), F.col(opponent).cast("double").alias("_o"))))
    got = df.groupBy(key).agg(F.count("*").alias("games"), games.alias("g"))
    step = lambda r, x: r + k * (x["_w"] - 1 / (1 + F.pow(F.lit(10.0), (x["_o"] - r) / 400)))
    return got.select(key, "games", F.round(F.aggregate("g", F.lit(start), step), 4).alias("rating"))


def accepted_while_rising(df: DataFrame, batch: str, score: str, base: float = 0.55, step: float = 0.015, per: int = 10_000, top: float = 0.88) -> DataFrame:
    """(batch, threshold, accepted): the mark of a batch depends on how many rows earlier batches had accepted.

    Batches are taken in order, each with one aggregate over its own rows, which are written once by batch. Rows without a
    batch or score are left out; a batch with none has no row.
    """
    rows = df.select(F.col(batch).alias("batch"), F.col(score).cast("double").alias("score")).where("batch is not null and score is not null and not isnan(score)")
    kind, path = dict(rows.dtypes)["batch"], fresh_path(df.sparkSession, "scores")
    names = rows.groupBy("batch").count().select("batch", F.row_number().over(Window.orderBy("batch")).alias("_i"))
    rows.join(F.broadcast(names), "batch").repartition("_i").write.partitionBy("_i").parquet(path)
    written, total, out = df.sparkSession.read.schema(f"batch {kind}, score double, _i int").parquet(path), 0, []
    for r in names.orderBy("_i").collect():  # one row per batch
        mark = min(top, base + step * total / per)
        n = written.where((F.col("_i") == r["_i"]) & (F.col("score") >= mark)).count()
        out.append((r.batch, round(mark, 9), n))
        total += n
    return df.sparkSession.createDataFrame(out, f"batch {kind}, threshold double, accepted long")


def adaptive_level(df: DataFrame, key: str, order: list[str], passed: str, window: int = 6, low: float = 0.5, high: float = 0.8, bottom: int = 1, top: int = 8, start: int = 2) -> DataFrame:
    """(key, level, changes): the level rises (up to ``top``) when the pass rate of the last ``window`` tasks exceeds ``high``, falls (down to
    ``bottom``) below ``low``, and the window starts anew with each change."""
    ys = F.transform(F.array_sort(F.collect_list(F.struct(*[F.col(o) for o in order], F.col(passed).cast("int").alias("_y")))), lambda x: x["_y"])
    got = df.groupBy(key).agg(ys.alias("ys"))
    init = F.struct(F.lit(start).alias("level"), F.lit(0).alias("changes"), F.array().cast("array<int>").alias("w"))

    def step(s: Column, y: Column) -> Column:
        w = F.concat(s["w"], F.array(y))
        full = F.size(w) >= window
        rate = F.aggregate(w, F.lit(0.0), lambda a, x: a + x) / F.size(w)
        up, down = full & (rate > high) & (s["level"] < top), full & (rate < low) & (s["level"] > bottom)
        level = s["level"] + up.cast("int") - down.cast("int")
        kept = F.when(up | down, F.array().cast("array<int>")).when(full, F.slice(w, 2, window)).otherwise(w)
        return F.struct(level.alias("level"), (s["changes"] + (up | down).cast("int")).alias("changes"), kept.alias("w"))

    return got.select(key, F.aggregate("ys", init, step).alias("s")).select(key, "s.level", "s.changes")


def odometer(n: Column, sizes: list[int]) -> list[Column]:
    """Digits of a running number in a mixed base, the last one turning fastest."""
    out, base = [], 1
    for s in reversed(sizes):
        out.append(F.pmod(F.floor(n / base), F.lit(s)).cast("int"))
        base *= s
    return out[::-1]


def trend(df: DataFrame, key: str, order: list[str], value: str, up: list[str], down: list[str], window: int = 5, least: int = 3) -> DataFrame:
    """Adds ``trend`` over the last ``window`` rows: positive (or needs_support) where more than twice as many values are of ``up`` (``down``)
    as of the other, else mixed; starting before the key has ``least`` rows."""
    w = Window.partitionBy(key).orderBy(*order)
    last = w.rowsBetween(-(window - 1), 0)
    pos, neg = (F.sum(F.coalesce(F.col(value).isin(x), F.lit(False)).cast("int")).over(last) for x in (up, down))
    return df.withColumn("trend", F.when(F.row_number().over(w) < least, "starting").when(pos > 2 * neg, "positive").when(neg > 2 * pos, "needs_support").otherwise("mixed"))
