"""Duplicates hidden by formatting: an incremental ledger of canonical keys."""

from __future__ import annotations

import hashlib
import json
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.functions.words import words
from lathework.session import fresh_path, materialise

_FORMAT = regex.compile(r"\p{Cf}+")
_SPLIT = regex.compile(r"\s*\n\s*|\s+\|\s+|;\s+")
_FIELD = regex.compile(r"\s*([\p{L}_][\p{L}\p{M}\p{N}_.-]*(?:\s+[\p{L}\p{M}\p{N}_.-]+){0,2})\s*:(?:\s+(.*)|)$", regex.S)


def letters(text: str | None) -> str:
    """The words of a text without any gaps."""
    return "".join(words(text))


def _flat(v) -> str:
    if isinstance(v, dict):
        return "{" + ",".join(f"{letters(str(a))}:{_flat(b)}" for a, b in sorted(v.items(), key=lambda x: str(x[0]))) + "}"
    if isinstance(v, list):
        return "[" + ",".join(map(_flat, v)) + "]"
    return letters(v if isinstance(v, str) else "" if v is None else json.dumps(v))


def record_fields(text: str | None) -> list[tuple[str, str]] | None:
    """Sorted names and values of a serialised record of two fields or more; null where the text isn't one.

    A JSON object, or ``name: value`` fields divided by line breaks, `` | `` or ``; ``. What follows a divider but has
    no name belongs to the field before.
    """
    if not text or ":" not in (t := unicodedata.normalize("NFKC", text)):
        return None
    t = _FORMAT.sub("", t).strip()
    if t[:1] == "{" and t[-1:] == "}":
        try:
            got = json.loads(t, strict=False, object_pairs_hook=lambda ps: ps)
        except (ValueError, RecursionError):
            got = None
        if isinstance(got, list) and len(got) > 1:
            return sorted((letters(k), _flat(dict(v) if isinstance(v, list) and v and isinstance(v[0], tuple) else v)) for k, v in got)
        if got is not None:
            return None
    fields: list[list[str]] = []
    for part in _SPLIT.split(t):
        if m := _FIELD.match(part):
            fields.append([m[1], m[2] or ""])
        elif fields:
            fields[-1][1] += " " + part
        else:
            return None
    if len(fields) < 2:
        return None
    return sorted((letters(k), letters(v)) for k, v in fields)


def canonical_keys(text: str | None) -> tuple[bytes, bytes | None]:
    """128-bit keys of the letters of a text and, for a record, of its sorted fields."""
    raw = hashlib.md5(b"t" + letters(text).encode(errors="surrogatepass")).digest()
    fields = record_fields(text)
    if fields is None:
        return raw, None
    return raw, hashlib.md5(b"r" + "\x00".join(f"{k}\x01{v}" for k, v in fields).encode(errors="surrogatepass")).digest()


def _keyed(batches):
    for b in batches:
        got = [canonical_keys(t) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([r or w for w, r in got], pa.binary()), pa.array([w if r else None for w, r in got], pa.binary()), b.column(2)], ["id", "key", "raw", "batch"]
        )


class Ledger:
    """Counts and earliest representative of each canonical key, in hash buckets in the shared folder.

    A batch is aggregated first (in part before the shuffle, so a key that a third of all rows share is cheap), then
    joined with the buckets its keys fall into; only these are written anew, under new paths, so a job that dies leaves
    the former state.
    """

    def __init__(self, spark: SparkSession, buckets: int = 8, path: str | None = None):
        self.spark, self.buckets, self.path = spark, buckets, path or fresh_path(spark, "ledger")
        self.at: dict[int, str] = {}
        self.version = 0

    SCHEMA, MANIFEST = "key binary, n long, keep long", "bucket int, path string"

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int = 8) -> Ledger:
        """The ledger as its last complete update left it. ``buckets`` must be what it was made with."""
        self = cls(spark, buckets, path)
        fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        while fs.exists(fs_path(f"{path}/manifest/v={self.version + 1}/_SUCCESS")):
            self.version += 1
        if self.version:
            self.at = {r.bucket: r.path for r in spark.read.schema(self.MANIFEST).parquet(f"{path}/manifest/v={self.version}").collect()}
        return self

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """(key, n, keep)."""
        paths = [p for b, p in sorted(self.at.items()) if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(*paths)

    def update(self, batch: DataFrame) -> None:
        """Add a batch of (key, id)."""
        new = materialise(batch.groupBy("key").agg(F.count("*").alias("n2"), F.min("id").alias("keep2")), "batch")
        bucket = F.expr(f"pmod(xxhash64(key), {self.buckets})").cast("int")
        touched = [r[0] for r in new.select(bucket.alias("b")).distinct().collect()]
        if not touched:
            return
        old = self.read(touched)
        merged = old.join(new, "key", "full_outer").select(
            "key", (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n"), F.least("keep", "keep2").alias("keep"), bucket.alias("bucket")
        )
        self.version += 1
        at = f"{self.path}/v{self.version}"
        merged.write.mode("overwrite").partitionBy("bucket").parquet(at)
        self.at |= {b: f"{at}/bucket={b}" for b in touched}
        self.spark.createDataFrame(sorted(self.at.items()), self.MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/v={self.version}")


def formatting_duplicates(df: DataFrame, id_col: str, text_col: str, batch_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Two tables: (keep_id, copies), a row for each text that is one apart from form, and (keep_id, copy_id), a row for
    each further copy. keep_id is the smallest id.

    Texts are copies when their letters, marks and digits are the same in the same order, or when they are records of the
    same names and values. ``batch_col`` (of few values, in their order) says how the rows arrive; each value is one
    update of the ledger. A text that isn't a record but has the letters of one joins it. Null texts count as
    empty, and texts without letters are one; rows without an id are left out; an empty table gives no rows.
    """
    spark = df.sparkSession
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), (F.col(batch_col).cast("string") if batch_col else F.lit("0")).alias("batch")).where("id is not null")
    keyed = materialise(src.mapInArrow(_keyed, "id long, key binary, raw binary, batch string"), "keyed")
    ledger = Ledger(spark)
    batches = sorted((r[0] for r in keyed.select("batch").distinct().collect()), key=lambda x: (x is None, x))
    for b in batches:
        ledger.update(keyed.where(F.col("batch").eqNullSafe(F.lit(b))).select("key", "id"))
    alias = keyed.where("raw is not null").groupBy(F.col("raw").alias("key")).agg(F.min("key").alias("to"))
    named = ledger.read().join(alias, "key", "left").select("key", F.coalesce("to", "key").alias("canon"), "n", "keep")
    # a second sum only where letters led to a record
    folded = named.groupBy("canon").agg(F.sum("n").alias("copies"), F.min("keep").alias("keep_id"))
    book = materialise(folded.where("copies > 1"), "book")
    to = named.select("key", "canon").join(book, "canon").select("key", "keep_id")
    members = keyed.select("key", "id").join(to, "key").where("id <> keep_id").select("keep_id", F.col("id").alias("copy_id"))
    return folded.select("keep_id", "copies"), members
