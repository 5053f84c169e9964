"""Audits, dashboards and score tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lathework.functions.text import length_bucket, line_count, strip


def audit(df: DataFrame, question: str, answer: str, key: Column, q: int = 8, a: int = 20) -> DataFrame:
    """One row: rows, empty, short, duplicates (rows after the first of a key; empty keys are never duplicates), dup_rate, unique.

    Rows are first counted by key, so the distinct count is one aggregation with partial sums.
    """
    ql, al = F.length(strip(F.coalesce(F.col(question), F.lit("")))), F.length(strip(F.coalesce(F.col(answer), F.lit(""))))
    empty = (ql == 0) | (al == 0)
    per = df.select(key.alias("k"), empty.alias("e"), (~empty & ((ql < q) | (al < a))).alias("s")).groupBy("k").agg(
        F.count("*").alias("n"), F.count_if("e").alias("e"), F.count_if("s").alias("s")
    )
    filled = F.col("n") - F.col("e")
    got = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"), F.coalesce(F.sum("e"), F.lit(0)).cast("long").alias("empty_rows"), F.coalesce(F.sum("s"), F.lit(0)).cast("long").alias("short_rows"),
        F.coalesce(F.sum(F.when((F.col("k") != "") & (filled > 1), filled - 1)), F.lit(0)).cast("long").alias("duplicates"),
    )
    return got.withColumn("dup_rate", F.round(F.col("duplicates") / F.greatest(F.col("rows"), F.lit(1)), 4)).withColumn("unique_estimate", F.col("rows") - F.col("duplicates") - F.col("empty_rows"))


def counts(df: DataFrame, c: Column, name: str, top: int | None = None) -> DataFrame:
    """(name, n), most frequent first in ``top``; null is a value of its own."""
    got = df.groupBy(c.alias(name)).agg(F.count("*").alias("n"))
    return got if top is None else got.orderBy(F.desc("n"), F.asc_nulls_last(name)).limit(top)


def length_histogram(df: DataFrame, **cols: str) -> DataFrame:
    """(field, bucket, n) of several text columns in one pass."""
    rows = F.array(*[F.struct(F.lit(n).alias("field"), length_bucket(F.length(F.coalesce(F.col(c), F.lit("")))).alias("bucket")) for n, c in cols.items()])
    return df.select(F.explode(rows).alias("x")).groupBy("x.field", "x.bucket").agg(F.count("*").alias("n"))


def per_day(df: DataFrame, time_col: str, last: int | None = None) -> DataFrame:
    """(day, n), oldest first; with ``last`` only the latest days."""
    got = df.where(F.col(time_col).isNotNull()).groupBy(F.to_date(time_col).alias("day")).agg(F.count("*").alias("n"))
    return got if last is None else got.orderBy(F.desc("day")).limit(last).orderBy("day")


def progress(df: DataFrame, target: int) -> DataFrame:
    """Rows and files read, and the share of a target."""
    got = df.select(F.col("_metadata.file_path").alias("f")).groupBy("f").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"), F.count("*").alias("files"))
    pct = F.round(100.0 * F.col("rows") / target, 2)
    return got.withColumn("percent", pct).withColumn("bar", F.rpad(F.repeat(F.lit("#"), F.least(F.lit(20), F.floor(pct / 5)).cast("int")), 20, "-"))


def weak_topics(df: DataFrame, topic: str, rating: str, least: int = 5, below: float = 3.5) -> DataFrame:
    """Topics (lower case, blanks as underscores) of ``least`` castable ratings or more whose mean is below a mark."""
    r = F.col(rating).try_cast("double")
    t = F.regexp_replace(F.lower(F.trim(F.coalesce(F.col(topic), F.lit("general")))), " +", "_")
    got = df.select(t.alias("topic"), r.alias("r")).where("r is not null and not isnan(r)").groupBy("topic").agg(F.round(F.avg("r"), 3).alias("avg_rating"), F.count("*").alias("n"))
    return got.where((F.col("n") >= least) & (F.col("avg_rating") < below))


def scores(df: DataFrame, group: str, score: Column) -> DataFrame:
    """(group, mean_score, n) of each group, and of all under "overall"."""
    got = df.select(F.col(group).alias("g"), score.cast("double").alias("s")).where("s is not null").rollup("g").agg(F.round(F.avg("s"), 6).alias("mean_score"), F.count("*").alias("n"), F.grouping("g").alias("all"))
    return got.select(F.when(F.col("all") == 1, "overall").otherwise(F.col("g")).alias(group), "mean_score", "n")


def relative_advantage(df: DataFrame, group: str, reward: str) -> DataFrame:
    """Adds ``advantage``: the reward against its group's mean, in group deviations. Group figures are aggregated and joined."""
    stats = df.groupBy(F.col(group).alias("_g")).agg(F.avg(reward).alias("_m"), F.stddev_pop(reward).alias("_s"))
    got = df.join(stats, F.col(group).eqNullSafe(F.col("_g")), "left")
    return got.withColumn("advantage", F.round((F.col(reward) - F.col("_m")) / (F.col("_s") + 1e-6), 6)).drop("_g", "_m", "_s")


def best_and_worst(df: DataFrame, group: str, row_id: str, reward: str, gap: float = 0.5) -> DataFrame:
    """(group, best, worst, gap) where rewards of a group lie at least ``gap`` apart; ties go to the smaller id."""
    got = df.where(F.col(reward).isNotNull()).groupBy(group).agg(
        F.min_by(row_id, F.struct(-F.col(reward), F.col(row_id))).alias("best"), F.min_by(row_id, F.struct(F.col(reward), F.col(row_id))).alias("worst"), F.round(F.max(reward) - F.min(reward), 6).alias("gap")
    )
    return got.where(F.col("gap") >= gap)


def approx_lines(df: DataFrame, question: str, answer: str, group: str) -> DataFrame:
    """Lines of questions and answers with two more for each pair."""
    return df.groupBy(group).agg(F.sum(line_count(F.col(question), F.col(answer)) + 2).cast("long").alias("lines"))


def hourly_rate(df: DataFrame, time_col: str) -> DataFrame:
    """Rows, hours between the first and the last, and rows a day at that pace."""
    got = df.agg(F.count(time_col).alias("n"), ((F.unix_timestamp(F.max(time_col)) - F.unix_timestamp(F.min(time_col))) / 3600).alias("hours"))
    return got.select("n", F.round("hours", 4).alias("hours"), F.round(F.col("n") / F.greatest(F.col("hours"), F.lit(1.0)) * 24, 2).alias("per_day"))


def with_moving_mean(df: DataFrame, group: str, order: list[str], value: str, rows: int = 8) -> DataFrame:
    """Adds ``moving_mean`` over the last ``rows`` rows of the group."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(-(rows - 1), 0)
    return df.withColumn("moving_mean", F.round(F.avg(value).over(w), 6))


def shortest_passing(df: DataFrame, key: str, row: str, score: str, length: str, least: float) -> DataFrame:
    """(key, best, worst): of the rows that reach ``least`` the shortest (the better score of equal ones), and of all the
    one with the lowest score (the longest of equal ones); null where none passes, and no worst where it is the best."""
    ok = F.col(score) >= least
    best = F.min_by(F.when(ok, F.col(row)), F.when(ok, F.struct(F.col(length), -F.col(score), F.col(row))))
    worst = F.min_by(row, F.struct(F.col(score), -F.col(length), F.col(row)))
    got = df.where(F.col(score).isNotNull()).groupBy(key).agg(best.alias("best"), worst.alias("worst"))
    return got.withColumn("worst", F.when(F.col("worst") != F.coalesce("best", F.lit(-1)), F.col("worst")))


def tree_stats(df: DataFrame, *levels: str) -> DataFrame:
    """One row: how many distinct paths a tree of levels has down to each."""
    paths = [[F.col(x) for x in levels[: i + 1]] for i in range(len(levels))]
    return df.agg(*[F.count_distinct(*p).alias(f"n_{x}") for p, x in zip(paths, levels)])


def status(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row: rows and newest time of each table, as (name: (table, time column))."""
    out = None
    for name, (df, at) in tables.items():
        one = df.agg(F.count("*").alias(f"{name}_rows"), F.max(at).alias(f"{name}_last"))
        out = one if out is None else out.join(F.broadcast(one))  # one row each
    return out
