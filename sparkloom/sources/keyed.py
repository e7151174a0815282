"""A table of rows by key whose upserts touch only what changes.

Rows lie in buckets by a hash of the key, every cell with the time of its last
write.  An upsert reads and writes anew the buckets that its keys fall in; a
manifest, one small file a version, names the folder of each bucket, so the
files of all others stay as they are and readers see a version whole or not at
all.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.sources.workspace import remove


class Conflict(Exception):
    """Another writer made the version that this one was about to make."""


@dataclass(frozen=True)
class KeyedTable:
    """The table below ``path`` with key ``key`` and nullable ``cells``; ``buckets`` are fixed when it is made."""

    spark: SparkSession
    path: str
    key: str
    cells: T.StructType
    buckets: int

    @staticmethod
    def create(spark: SparkSession, path: str, schema: str | T.StructType, key: str, buckets: int = 64) -> "KeyedTable":
        """An empty table unless there is one; of an existing one the schema and buckets count."""
        if KeyedTable.exists(spark, path):
            return KeyedTable.open(spark, path)
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        about = {"schema": json.loads(fields.json()), "key": key, "buckets": buckets, "folders": {}, "runs": []}
        _put(spark, f"{path}/manifest/0.json", json.dumps(about))
        return KeyedTable.open(spark, path)

    @staticmethod
    def exists(spark: SparkSession, path: str) -> bool:
        return bool(_versions(spark, path))

    @staticmethod
    def open(spark: SparkSession, path: str) -> "KeyedTable":
        about = _manifest(spark, path)[1]
        fields = T.StructType.fromJson(about["schema"])
        return KeyedTable(spark, path, about["key"], T.StructType([f for f in fields.fields if f.name != about["key"]]), about["buckets"])

    @property
    def _stored(self) -> T.StructType:
        """The columns of a file: a cell is its value and the time of its write."""
        fields = T.StructType.fromJson(_manifest(self.spark, self.path)[1]["schema"])
        key = next(f for f in fields.fields if f.name == self.key)
        return T.StructType([key, *[T.StructField(f.name, T.StructType([T.StructField("at", T.LongType()), T.StructField("value", f.dataType)])) for f in self.cells.fields]])

    def _files(self, folders: dict[str, str]) -> DataFrame:
        """Cells of the named buckets, by the paths that the manifest gives: nothing else is listed or read."""
        if not folders:
            return self.spark.createDataFrame([], self._stored)
        return self.spark.read.schema(self._stored).parquet(*[f"{self.path}/data/{folder}/bucket={b}" for b, folder in sorted(folders.items())])

    def read(self, times: bool = False) -> DataFrame:
        """The rows as of the last version; with ``times`` also ``<cell>_at``."""
        rows = self._files(_manifest(self.spark, self.path)[1]["folders"])
        names = [f.name for f in self.cells.fields]
        return rows.select(self.key, *[F.col(f"{c}.value").alias(c) for c in names], *[F.col(f"{c}.at").alias(f"{c}_at") for c in names * times])

    def upsert(self, new: DataFrame, at: Column | int, run: str | None = None) -> list[int]:
        """Write the non-null cells of ``new``, as of the time ``at``; the buckets that were written.

        Of several writes of a cell, in one upsert or in many and whatever their
        order, the one with the latest time stays, of equal times the greatest
        value.  A null cell, or one that ``new`` lacks, is not written; a row
        with the key alone is.  ``run`` names an upsert: one that is repeated
        after it was committed does nothing, one that failed starts over.
        Writes of a key meet after they are combined where they are.
        """
        version, about = _manifest(self.spark, self.path)
        if run is not None and run in about["runs"]:
            return []
        when = F.lit(at).cast("bigint") if isinstance(at, int) else at.cast("bigint")
        given = [f for f in self.cells.fields if f.name in new.columns]
        one = {f.name: F.when(F.col(f.name).isNotNull(), F.struct(F.col("_at").alias("at"), F.col(f.name).cast(f.dataType).alias("value"))) for f in given}
        cells = [one.get(f.name, F.lit(None).cast(self._stored[f.name].dataType)).alias(f.name) for f in self.cells.fields]
        key = F.col(self.key).cast(self._stored[self.key].dataType).alias(self.key)
        last = [F.max(f.name).alias(f.name) for f in self.cells.fields]
        fresh = new.withColumn("_at", when).select(key, *cells).groupBy(self.key).agg(*last)
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        # Bounded: a number for each bucket at most.
        touched = sorted(r.b for r in fresh.select(bucket.alias("b")).distinct().collect())
        if not touched:
            return []
        old = self._files({b: f for b, f in about["folders"].items() if int(b) in touched})
        merged = old.unionByName(fresh).groupBy(self.key).agg(*last).withColumn("bucket", bucket)
        folder = f"v{version + 1}-{_token()}"
        merged.repartition(min(len(touched), self.buckets), "bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{folder}")
        about["folders"] |= {str(b): folder for b in touched}
        about["runs"] = [*about["runs"], *([run] if run is not None else [])][-1000:]
        try:
            _put(self.spark, f"{self.path}/manifest/{version + 1}.json", json.dumps(about))
        except Conflict:
            remove(self.spark, f"{self.path}/data/{folder}")
            raise
        return touched

    def vacuum(self, keep: int = 1) -> None:
        """Delete what none of the last ``keep`` versions names; a reader or writer of an older one fails."""
        versions = _versions(self.spark, self.path)
        for n in versions[:-keep]:
            remove(self.spark, f"{self.path}/manifest/{n}.json")
        named = {(b, f) for n in versions[-keep:] for b, f in json.loads(_get(self.spark, f"{self.path}/manifest/{n}.json"))["folders"].items()}
        for folder in _list(self.spark, f"{self.path}/data"):
            parts = [b for b in _list(self.spark, f"{self.path}/data/{folder}") if b.startswith("bucket=")]
            gone = [b for b in parts if (b.removeprefix("bucket="), folder) not in named]
            for b in [""] if len(gone) == len(parts) else gone:
                remove(self.spark, f"{self.path}/data/{folder}/{b}".rstrip("/"))


def _token() -> str:
    return uuid.uuid4().hex[:12]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _list(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in _list(spark, f"{path}/manifest") if n.endswith(".json"))


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict]:
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(path)
    return versions[-1], json.loads(_get(spark, f"{path}/manifest/{versions[-1]}.json"))


def _get(spark: SparkSession, path: str) -> str:
    return "".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A small file at once: written aside, then given its name unless that is taken."""
    aside, fs = _fs(spark, f"{path}.{_token()}.tmp")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    target, _ = _fs(spark, path)
    taken = fs.exists(target)
    if taken or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise Conflict(path)
