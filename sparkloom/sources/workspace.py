"""The folder that driver and executors share, and tables written once to it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a few narrow columns up to which a table is broadcast.
BROADCAST_ROWS = 1 << 19


def folder(spark: SparkSession, tag: str) -> str:
    """A new path below ``spark.checkpoint.dir``; only in local mode a temporary folder where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="sparkloom-")
    return f"{base.rstrip('/')}/sparkloom/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """A scan of ``df`` written once, and its path; a lost executor costs a re-read."""
    path = folder(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def bounded(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``rows``, a few narrow columns, to be broadcast where a count shows ``most`` at most; else as they are."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows
