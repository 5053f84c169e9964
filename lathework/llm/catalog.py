"""Queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.llm.history import known_questions
from lathework.llm.languages import fit_languages, language_passages, mislabelled
from lathework.llm.leaks import leaked_items
from lathework.llm.ledger import formatting_duplicates
from lathework.llm.mixture import mix
from lathework.llm.near_duplicates import near_duplicate_groups
from lathework.llm.pairs import broken_pairs
from lathework.llm.subjects import fit_subjects, subject_areas
from lathework.llm.tokens import token_ids
from lathework.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return mislabelled(table(spark, d, "daily_lessons"), "lesson_id", "answer", "lang").withColumnRenamed("id", "lesson_id")


def p1_passages(spark: SparkSession, d: str) -> DataFrame:
    lessons = table(spark, d, "daily_lessons")
    got = language_passages(lessons, "lesson_id", "answer", fit_languages(lessons, "lesson_id", "answer", "lang"))
    return got.select(F.col("id").alias("lesson_id"), F.posexplode("passages").alias("passage", "p")).select("lesson_id", "passage", "p.lang", "p.confidence", F.length("p.text").alias("n_chars"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    got = leaked_items(table(spark, d, "hot_vectors"), "knowledge_id", "question", table(spark, d, "benchmark"), "id", ["question", "reference"])
    return got.select(F.col("item_id").alias("id"), F.col("id").alias("knowledge_id"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return broken_pairs(table(spark, d, "daily_lessons"), "lesson_id", "question", "answer", "lang").withColumnRenamed("id", "lesson_id")


def _p4(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, d, "hot_vectors").withColumn("month", F.date_format("embedded_at", "yyyy-MM"))
    return formatting_duplicates(rows, "knowledge_id", "question", "month")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _p4(spark, d)[1]


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    return _p4(spark, d)[0]


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    got = near_duplicate_groups(table(spark, d, "hot_vectors"), "knowledge_id", ["question", "answer"], k=3, threshold=0.5)
    return got.withColumnRenamed("id", "knowledge_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    got = known_questions(table(spark, d, "hot_vectors"), "knowledge_id", "question", table(spark, d, "daily_lessons"), "lesson_id", "lesson_day", "question", k=2, threshold=0.6)
    return got.withColumnRenamed("id", "lesson_id")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return token_ids(table(spark, d, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


def _p8(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), "doc_id", "text", "source")


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return _p8(spark, d)[0].withColumnRenamed("id", "doc_id")


def p8_uses(spark: SparkSession, d: str) -> DataFrame:
    return p8_mix(spark, d).groupBy("doc_id", "source", "tokens").agg(F.count("*").alias("uses"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return _p8(spark, d)[1]


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = fit_subjects(docs, table(spark, d, "doc_subjects"), "doc_id", "text", "source", "subject", "lang")
    return subject_areas(docs, "doc_id", "text", "source", model).select(F.col("id").alias("doc_id"), "subject")


def p9_composition(spark: SparkSession, d: str) -> DataFrame:
    """The corpus by subject: documents and their characters."""
    docs = table(spark, d, "documents").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n"))
    got = p9_found(spark, d).join(docs, "doc_id")
    return got.groupBy("subject").agg(F.count("*").alias("documents"), F.sum("n").alias("chars"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fs = (p1_found, p1_passages, p2_found, p3_found, p4_found, p4_records, p5_found, p6_found, p7_ids, p8_mix, p8_uses, p8_shares, p9_found, p9_composition)
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    return {}
