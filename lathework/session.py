"""Session helpers: building a local session and finding the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, memory: str = "8g", app: str = "lathework", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it in ``spark.checkpoint.dir``.

    Only a session with a local master may go without; it gets a temporary folder.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not path:
        if not conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="lathework-", dir=os.environ.get("TMPDIR"))
        spark.sparkContext.setCheckpointDir(path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the work folder that nothing uses yet."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the work folder and read it back: cuts the lineage and survives lost executors."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
