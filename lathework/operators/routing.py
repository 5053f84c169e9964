"""Routing of texts to tools, and look-ups in small catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lathework.operators.decontaminate import bounded


def route(texts: DataFrame, id_col: str, text: Column, tools: DataFrame, k: int = 3, least: float = 1.0, fallback: str | None = None) -> DataFrame:
    """(id, tool, score, rank): the best tools for each text.

    ``tools`` (tool, keywords array, pattern, bonus) is a small catalogue, broadcast after a check of its size. Each keyword in the
    text scores 1, the pattern 1.5, and the bonus is added where anything hits; scores below ``least`` don't count. A text
    without a tool gets the fallback, if there is one.
    """
    rows = texts.select(F.col(id_col).alias("id"), F.lower(F.coalesce(text, F.lit(""))).alias("t"))
    words = F.size(F.filter("keywords", lambda w: F.contains(F.col("t"), F.lower(w))))
    hits = words + F.when(F.coalesce(F.expr("t rlike pattern"), F.lit(False)), 1.5).otherwise(0.0)
    score = F.round(hits + F.when(hits > 0, F.coalesce(F.col("bonus"), F.lit(0.0))).otherwise(0.0), 4)
    got = rows.crossJoin(bounded(tools, 1000)).select("id", "tool", score.alias("score")).where(F.col("score") >= least)  # texts against the catalogue's few rows
    w = Window.partitionBy("id").orderBy(F.desc("score"), "tool")
    best = got.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    if fallback is None:
        return best
    rest = rows.join(best.select("id").distinct(), "id", "left_anti").select("id", F.lit(fallback).alias("tool"), F.lit(0.0).alias("score"), F.lit(1).alias("rank"))
    return best.unionByName(rest)


def catalogue_search(df: DataFrame, text: str, query: str, kind_col: str | None = None, kind: str | None = None, most: int = 120, order: str | None = None) -> DataFrame:
    """Rows whose normalised text holds the normalised query, of one kind if given; the first ``most`` in order."""
    norm = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "")
    got = df.where(F.contains(norm(F.col(text)), norm(F.lit(query))))
    got = got if kind is None else got.where(F.col(kind_col) == kind)
    return got.orderBy(order or text).limit(most)


def accepted_answers(questions: DataFrame, answers: DataFrame, accepted: str, answer_id: str, answer_text: str, least: int = 40) -> DataFrame:
    """Questions with the text of their accepted answer, where that has more than ``least`` signs."""
    a = answers.select(F.col(answer_id).alias("_aid"), F.col(answer_text).alias("accepted_text"))
    return questions.join(a, F.col(accepted) == F.col("_aid")).where(F.length("accepted_text") > least).drop("_aid")


def same_answer(a: Column, b: Column, within: float = 1e-6) -> Column:
    """Equal as normalised texts, or as numbers within a relative bound."""
    norm = lambda c: F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), r"[\s,$%]+|\.$", "")
    x, y = norm(a).try_cast("double"), norm(b).try_cast("double")
    near = F.abs(x - y) <= within * F.greatest(F.lit(1.0), F.abs(x), F.abs(y))
    return F.coalesce((norm(a) == norm(b)) & (norm(a) != ""), F.lit(False)) | F.coalesce(near, F.lit(False))


def repeated_errors(df: DataFrame, kind: str, time_col: str, ring: int = 500, least: int = 3) -> DataFrame:
    """(kind, n) of kinds that occur ``least`` times among the latest ``ring`` rows."""
    last = df.orderBy(F.desc(time_col)).limit(ring)
    return last.groupBy(kind).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def stride(df: DataFrame, position: str, worker: int, workers: int) -> DataFrame:
    """The rows that fall to one of several workers."""
    return df.where(F.pmod(F.col(position), F.lit(workers)) == worker)


def index_sizes(rows: int, dim: int, m: int = 64) -> tuple[int, int]:
    """Lists of an inverted index for so many vectors, and sub-quantisers that divide the dimension."""
    lists = max(1, min(65_536, int(4 * rows**0.5)))
    while m > 1 and dim % m:
        m //= 2
    return lists, max(1, m)
