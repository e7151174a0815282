"""Streaming ingest: filter, map to columns, upsert every micro-batch by key."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkloom.sources.sinks import save_state
from sparkloom.sources.tables import state, version_path, versions
from sparkloom.sources.workspace import remove


def source(spark: SparkSession, folder: str, schema, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_batch", T.LongType())])


def current(spark: SparkSession, target: str, schema: T.StructType, key: str, before: int | None = None) -> DataFrame:
    """The table as of all batches (or those ``before`` one): the last non-null value of each cell.

    It is the last compacted version with the batches since.
    """
    base = state(spark, f"{target}/base", _schema(schema))
    done = [n for n, _ in versions(spark, f"{target}/batches") if before is None or n <= before]
    parts = [base, *[spark.read.schema(_schema(schema)).parquet(version_path(f"{target}/batches", n)) for n in done]]
    both = reduce(DataFrame.unionByName, parts)
    cells = [f.name for f in schema.fields if f.name != key]
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_batch"))).alias(c)
    return both.groupBy(key).agg(*[last(c) for c in cells], F.max("_batch").alias("_batch")).select(*[f.name for f in schema.fields], "_batch")


def upsert_stream(stream: DataFrame, columns: dict[str, Column], key: str, target: str, checkpoint: str, where: Column | None = None, interval: str | None = None, order: str | None = None, compact_every: int = 100, keep: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Start a query that keeps ``target`` up to date by ``key``; read it with ``current``.

    A batch is written by itself, under its number, so it costs what it holds
    and a replay after a failure writes the same again.  Every ``compact_every``
    batches become a new base version.  Of rows of a batch that repeat a key
    the last by ``order`` stays, else the one with the greatest cells.  Without
    ``interval`` all that is there is taken and the query ends.  ``keep`` picks
    rows of a batch where a condition on one row can't.
    """
    rows = (stream if where is None else stream.where(where)).select(*[c.alias(n) for n, c in columns.items()])
    schema = rows.schema
    cells = [n for n in columns if n != key]

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = keep(batch) if keep else batch
        place = F.struct(*[F.col(c) for c in ([order] if order else []) + cells])
        last = batch.groupBy(key).agg(F.max_by(F.struct(*cells), place).alias("_row")).select(key, "_row.*")
        last.select(*[f.name for f in schema.fields], F.lit(number + 1).cast("bigint").alias("_batch")).write.mode("overwrite").parquet(version_path(f"{target}/batches", number + 1))
        done = [n for n, _ in versions(spark, f"{target}/batches")]
        if len(done) >= compact_every:
            save_state(current(spark, target, schema, key), f"{target}/base")
            for n in done:
                remove(spark, version_path(f"{target}/batches", n))

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
