"""A memory of question-answer episodes that is strengthened by use and fades without."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.text import SECRETS, jaccard, space_key, tokens


def episodes(df: DataFrame, question: str, answer: str, score: Column, verified: Column, order: str) -> DataFrame:
    """(key, question, answer, uses, verified, score, last): one row per pair; the score is the mean, .55 where none is given,
    at most 1. Questions under 3 signs, answers under 8, and texts that hold credentials aren't kept."""
    q, a = F.trim(F.coalesce(F.col(question), F.lit(""))), F.trim(F.coalesce(F.col(answer), F.lit("")))
    rows = df.select(F.md5(F.concat_ws("\x1f", space_key(q), space_key(a))).alias("key"), q.alias("question"), a.alias("answer"), F.least(F.lit(1.0), F.coalesce(score, F.lit(0.55))).alias("score"), F.coalesce(verified, F.lit(False)).alias("verified"), F.col(order).alias("at"))
    rows = rows.where((F.length("question") >= 3) & (F.length("answer") >= 8) & ~F.concat_ws(" ", "question", "answer").rlike(SECRETS))
    first = F.struct("at", "question", "answer")
    got = rows.groupBy("key").agg(F.min(first).alias("f"), F.count("*").alias("uses"), F.bool_or("verified").alias("verified"), F.round(F.avg("score"), 6).alias("score"), F.max("at").alias("last"))
    return got.select("key", "f.question", "f.answer", "uses", "verified", "score", "last")


def recall(memory: DataFrame, query: str, k: int = 6, least: float = 0.28) -> DataFrame:
    """The episodes that rank best for a query: score, verification, use, and shared words."""
    words = tokens(F.lit(query))
    rank = 0.5 * F.col("score") + 0.25 * F.col("verified").cast("int") + 0.15 * F.least(F.lit(1.0), F.col("uses") / 5) + 0.1 * jaccard(F.slice(F.array_distinct(tokens(F.col("question"))), 1, 80), F.slice(words, 1, 80))
    return memory.withColumn("rank", F.round(rank, 6)).where(F.col("rank") > least).orderBy(F.desc("rank"), "key").limit(k)


def after_feedback(memory: DataFrame, liked: Column) -> DataFrame:
    """Score up by .16 or down by .28 within 0..1; verified only by approval of a score of .72 or more; null leaves a row as it is."""
    s = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score") + F.when(liked, 0.16).when(~liked, -0.28).otherwise(0.0)))
    v = F.when(liked.isNull(), F.col("verified")).otherwise(liked & (s >= 0.72))
    return memory.withColumns({"score": F.round(s, 6), "verified": v})


def consolidated(memory: DataFrame, now: Column, most: int = 1500, least: float = 0.18, days: int = 30) -> DataFrame:
    """Verified, well scored or fresh episodes, the last ``most`` by key."""
    fresh = F.col("last") >= now - F.make_dt_interval(days=F.lit(days))
    return memory.where(F.col("verified") | (F.col("score") >= least) | fresh).orderBy(F.desc("key")).limit(most)


def longest_alias(texts: DataFrame, text: str, aliases: DataFrame, default: str) -> DataFrame:
    """Adds ``model_id``: that of the longest alias which occurs in the text. ``aliases`` (alias, id) is small and broadcast after a check."""
    from lathework.operators.decontaminate import bounded

    rows = texts.withColumn("_n", F.monotonically_increasing_id())
    hit = rows.select("_n", F.lower(text).alias("_t")).join(bounded(aliases), F.expr("contains(_t, lower(alias))"))
    best = hit.groupBy("_n").agg(F.max_by("id", F.struct(F.length("alias"), "id")).alias("model_id"))
    return rows.join(best, "_n", "left").withColumn("model_id", F.coalesce("model_id", F.lit(default))).drop("_n")
