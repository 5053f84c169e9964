"""Corpus preparation: gates, decontamination, duplicates, splits and balance in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.text import ascii_key, strip, unicode_key
from lathework.operators.balance import ranked, split_of
from lathework.operators.decontaminate import marked
from lathework.operators.normalize import chatml, messages
from lathework.operators.quality import DOMAINS_A, by_pattern
from lathework.session import materialise

REPEATS = {"medical": 3, "holy": 2, "agentic": 2}


def tagged(rows: DataFrame, items: DataFrame, item_text: str, row_id: str = "knowledge_id", q: int = 8, a: int = 20, test: float = 0.05, validation: float = 0.05, unicode: bool = False, split=split_of) -> DataFrame:
    """Each row with ``key``, ``domain``, and ``reason`` (short, empty, contaminated, duplicate) or ``split``.

    The first reason that holds counts: a row that is short, empty or contaminated doesn't make a later one a duplicate.
    Of rows of one key the one with the smallest id stays; it is found by an aggregate, so a key that many rows
    share is reduced before the shuffle. With the ASCII key (default) a text of another script has an empty key.
    ``split`` assigns splits by the key (``split_of``, ``split_by_blake2b``).
    """
    norm = unicode_key if unicode else ascii_key
    r = rows.withColumn("key", norm(F.col("question"))).withColumn("domain", by_pattern(F.col("intent"), DOMAINS_A))
    lq, la = F.length(strip(F.coalesce(F.col("question"), F.lit("")))), F.length(strip(F.coalesce(F.col("answer"), F.lit(""))))
    r = marked(r, F.col("key"), items, norm(F.col(item_text)), "leaked")
    r = r.withColumn("reason", F.when((lq < q) | (la < a), "short").when(F.col("key") == "", "empty").when(F.col("leaked"), "contaminated")).drop("leaked")
    first = r.where("reason is null").groupBy("key").agg(F.min(row_id).alias("_first"))
    r = r.join(first, "key", "left").withColumn("reason", F.when(F.col("reason").isNull() & (F.col(row_id) != F.col("_first")), "duplicate").otherwise(F.col("reason"))).drop("_first")
    return r.withColumn("split", F.when(F.col("reason").isNull(), split(F.col("key"), test, validation)))


def tags(rows: DataFrame, items: DataFrame, item_text: str, row_id: str = "knowledge_id", **gates) -> DataFrame:
    """The tags alone, written once, since balance and report both read them."""
    return materialise(tagged(rows, items, item_text, row_id, **gates).select(row_id, "domain", "reason", "split"), "tags")


def balanced(t: DataFrame, row_id: str = "knowledge_id", cap: int = 5000, repeats: dict[str, int] = REPEATS) -> DataFrame:
    """Rows that are left, with ``copies``: training rows up to ``cap`` per domain (0 where the cap is reached), others once."""
    times = F.lit(1)
    for d, n in repeats.items():
        times = F.when(F.col("domain") == d, F.lit(n)).otherwise(times)
    train = ranked(t.where("split = 'train'"), "domain", [row_id], "_r").withColumn("_t", times)
    train = train.withColumn("copies", F.greatest(F.lit(0), F.least(F.col("_t").cast("long"), F.lit(cap) - (F.col("_r") - 1) * F.col("_t"))).cast("int")).drop("_r", "_t")
    return train.unionByName(t.where("split in ('test', 'val')").withColumn("copies", F.lit(1)))


def training_rows(b: DataFrame, rows: DataFrame, row_id: str = "knowledge_id") -> DataFrame:
    """Rendered rows, one for each copy. Tags (id, domain, split, copies) are narrow, so texts are shuffled once, here."""
    kept = b.where("copies > 0").select(row_id, "domain", "split", "copies")
    m = messages(F.col("question"), F.col("answer"))
    got = rows.join(kept, row_id).withColumns({"text": chatml(m), "messages": F.to_json(m)})
    return got.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")


def report(t: DataFrame, b: DataFrame) -> DataFrame:
    """(kind, name, n): rows dropped by reason, kept by split, training rows by domain after balance, and rows capped."""
    entry = lambda kind, name, n: F.struct(F.lit(kind).alias("kind"), name.alias("name"), n.cast("long").alias("n"))
    dropped = t.where("reason is not null").select(F.array(entry("dropped", F.col("reason"), F.lit(1))).alias("e"))
    n = F.col("copies")
    kept = b.select(
        F.when(n == 0, F.array(entry("dropped", F.lit("capped"), F.lit(1))))
        .when(F.col("split") == "train", F.array(entry("split", F.col("split"), n), entry("train_domain", F.col("domain"), n)))
        .otherwise(F.array(entry("split", F.col("split"), n)))
        .alias("e")
    )
    return dropped.union(kept).select(F.explode("e").alias("x")).groupBy("x.kind", "x.name").agg(F.sum("x.n").alias("n"))
