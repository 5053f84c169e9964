"""Files of several formats read as one table, and landed payloads of feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = {"parquet": "parquet", "jsonl": "json", "ndjson": "json", "json": "json", "csv": "csv", "tsv": "csv"}
CONTAINERS = ["data", "rows", "items", "examples", "problems"]
NOT_DATA = ("manifest", "_state", "dataset_info", "config")


def list_files(spark: SparkSession, folder: str, extensions: set[str] | None = None, contains: str | None = None, skip: tuple[str, ...] = NOT_DATA) -> list[str]:
    """Data files below a folder, in order of their names.

    ``contains`` and ``skip`` are looked for in a file's name, and in that of the table where a table is a folder of part files
    (a folder named like a data file); what a writer left unfinished in such a folder is no data.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    out, it, root = [], fs.listFiles(path, True), fs.resolvePath(path).toString().rstrip("/")
    while it.hasNext():
        p = it.next().getPath().toString()
        path = p[len(root) + 1 :].lower().split("/")
        data = [n.rsplit(".", 1)[-1] in (extensions or FORMATS) for n in path]
        inside = path[data.index(True) + 1 :] if data[-1] else []
        names = [n for n, d in zip(path, data) if d]
        hidden = path[-1].startswith(("_", ".")) or any(n.startswith(("_", ".")) and "=" not in n for n in inside)
        if data[-1] and not hidden and not any(s in n for s in skip for n in names) and (contains is None or any(contains.lower() in n for n in names)):
            out.append(p)
    return sorted(out)


def unwrapped(df: DataFrame) -> DataFrame:
    """The rows of a JSON container (data, rows, items ...); other tables as they are."""
    for c in CONTAINERS:
        kind = dict(df.dtypes).get(c, "")
        if kind.startswith("array<struct"):
            return df.select(F.explode(c).alias("r")).select("r.*")
    return df


def read_any(spark: SparkSession, folder: str, contains: str | None = None) -> DataFrame | None:
    """All data files below a folder, columns joined by name, with ``source_file``; null where there is none.

    A file per format is read in one scan; corrupt files and malformed lines are skipped.
    """
    by: dict[str, list[str]] = {}
    for f in list_files(spark, folder, contains=contains):
        by.setdefault(f.rsplit(".", 1)[-1].lower(), []).append(f)
    out = []
    for ext, files in sorted(by.items()):
        r = spark.read.option("ignoreCorruptFiles", "true").option("mode", "DROPMALFORMED")
        if ext == "parquet":
            df = r.option("mergeSchema", "true").parquet(*files)
        elif ext in ("csv", "tsv"):
            df = r.option("header", "true").option("sep", "\t" if ext == "tsv" else ",").csv(files)
        else:
            df = r.option("multiLine", str(ext == "json").lower()).json(files)
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
        df = unwrapped(df) if ext == "json" else df
        out.append(df)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out) if out else None


def latest_files(spark: SparkSession, folder: str, n: int = 7, ext: str = "jsonl") -> DataFrame | None:
    """JSON lines of the last ``n`` files by name, bad lines skipped."""
    files = list_files(spark, folder, {ext})[-n:]
    return spark.read.option("mode", "DROPMALFORMED").json(files) if files else None


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of each text or Markdown file."""
    return spark.read.text(f"{folder}/*.{{txt,md}}", wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def unread(df: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of files that aren't among those done (``source_file``)."""
    return df.join(done.select("source_file").distinct(), "source_file", "left_anti")


def pages(df: DataFrame, id_col: str, size: int, mark: int | None = None) -> DataFrame:
    """Adds ``page``: where keyset paging by ``size`` would put a row past the mark."""
    from lathework.operators.balance import ranked

    rows = df if mark is None else df.where(F.col(id_col) > mark)
    return ranked(rows.withColumn("_all", F.lit(0)), "_all", [id_col], "_r").withColumn("page", F.floor((F.col("_r") - 1) / size)).drop("_all", "_r")


def feed_items(xml: Column) -> Column:
    """Items of an RSS or Atom document: array of (title, link, summary)."""
    part = lambda x, tag: F.trim(F.regexp_replace(F.regexp_extract(x, rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1), r"<!\[CDATA\[|\]\]>", ""))
    items = F.regexp_extract_all(F.coalesce(xml, F.lit("")), F.lit(r"(?s)<((?:item|entry)\b.*?)</(?:item|entry)>"), F.lit(1))
    href = lambda x: F.regexp_extract(x, r"<link[^>]*href=\"([^\"]+)\"", 1)
    summary = lambda x: F.coalesce(F.nullif(part(x, "description"), F.lit("")), part(x, "summary"))
    return F.transform(items, lambda x: F.struct(part(x, "title").alias("title"), F.coalesce(F.nullif(part(x, "link"), F.lit("")), href(x)).alias("link"), summary(x).alias("summary")))


QUAKES = "struct<features:array<struct<id:string,properties:struct<title:string,url:string,mag:double,place:string,time:bigint>>>>"
WORKS = "struct<results:array<struct<id:string,title:string,abstract_inverted_index:map<string,array<int>>>>,meta:struct<next_cursor:string>>"


def quake_items(payload: Column) -> Column:
    """Observations of a GeoJSON feed of earthquakes."""
    f = F.from_json(payload, QUAKES)["features"]
    return F.transform(f, lambda x: F.struct(x["properties"]["title"].alias("title"), x["properties"]["url"].alias("url"), x["properties"]["place"].alias("summary"), F.timestamp_millis(x["properties"]["time"]).alias("observed_at")))


def work_items(payload: Column) -> Column:
    """Scholarly works of a page of results, abstracts put together from their inverted index."""
    from lathework.operators.normalize import inverted_text

    return F.transform(F.from_json(payload, WORKS)["results"], lambda x: F.struct(x["id"].alias("id"), x["title"].alias("title"), inverted_text(x["abstract_inverted_index"]).alias("abstract")))
