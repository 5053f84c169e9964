"""Table-driven ingestion: which fields of which dataset make a question and its answer."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.operators.normalize import ANSWER_NAMES, QUESTION_NAMES, coalesced, first_pair, present


@dataclass(frozen=True)
class Spec:
    """kind: qa (fields), chat (a list of messages), or text (a text only)."""

    name: str
    kind: str = "qa"
    question: list[str] = field(default_factory=lambda: QUESTION_NAMES)
    answer: list[str] = field(default_factory=lambda: ANSWER_NAMES)
    intent: str = "general"
    licence: str | None = None


def parse_spec(text: str) -> Spec:
    """name:kind:intent[:licence]"""
    p = [x.strip() for x in text.split(":")]
    if not p[0] or (len(p) > 1 and p[1] not in ("qa", "chat", "text")):
        raise ValueError(f"not a dataset: {text!r}")
    return Spec(p[0], p[1] if len(p) > 1 else "qa", intent=p[2] if len(p) > 2 and p[2] else "general", licence=p[3] if len(p) > 3 and p[3] else None)


def pairs(df: DataFrame, spec: Spec) -> DataFrame:
    """question, answer, intent, dataset; rows without both are left out."""
    from lathework.operators.normalize import text_only_pair

    if spec.kind == "chat":
        col = (present(df, "messages", "conversations", "conversation") or [F.lit(None).cast("array<struct<role:string,content:string>>")])[0]
        got = df.select(first_pair(col).alias("p")).select("p.*")
    elif spec.kind == "text":
        col = (present(df, "text", *ANSWER_NAMES) or [F.lit(None).cast("string")])[0]
        got = df.select(text_only_pair(col).alias("p")).select("p.*")
    else:
        got = coalesced(coalesced(df.withColumn("_row", F.lit(0)), "_q", spec.question), "_a", [n for n in spec.answer]).select(F.col("_q").alias("question"), F.col("_a").alias("answer"))
    ok = (F.coalesce(F.trim("question"), F.lit("")) != "") & (F.coalesce(F.trim("answer"), F.lit("")) != "")
    return got.where(ok).withColumns({"intent": F.lit(spec.intent), "dataset": F.lit(spec.name)})


def ingest(tables: list[tuple[Spec, DataFrame]]) -> DataFrame:
    """All datasets as one table."""
    return reduce(lambda a, b: a.unionByName(b), [pairs(df, s) for s, df in tables])


def grid(spark, axes: dict[str, list[str]]) -> DataFrame:
    """Every combination of a few short lists, numbered in order (a syllabus, a curriculum)."""
    df = spark.range(1).drop("id")
    for name, values in axes.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df
