"""Shared storage and Arrow helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is hot when it has more than one in ``HOT_SHARES`` of all rows; so there are fewer hot keys than that.
HOT_SHARES = 1000

#: Rows of narrow keys up to which a counted table is broadcast.
BROADCAST_ROWS = 1 << 20

#: Narrow rows of a written file.
ROWS_PER_FILE = 200_000

#: Bytes of an Arrow batch (two slices of a pass: more would only wait in memory outside the heap), and the setting and its default.
BATCH_BYTES = "2097152b"
_BATCH, _SPARKS_OWN = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

_OWN_DIRS: dict[str, str] = {}


def workspace(spark: SparkSession) -> str:
    """Folder shared by driver and executors: ``spark.checkpoint.dir``.

    Only in local mode, where the session has none, a temporary folder is made,
    once per application; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_DIRS:
            _OWN_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="sparkloom-")
            spark.sparkContext.setCheckpointDir(_OWN_DIRS[app])
        base = _OWN_DIRS[app]
    return base.rstrip("/") + "/sparkloom"


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{workspace(spark)}/{tag}-{uuid.uuid4().hex}"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path of the shared folder, and the path there."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def materialize(df: DataFrame, tag: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    Cuts lineage: a lost executor costs a re-read of the written table, never a
    recomputation of what led to it.  ``rows``, an estimate, keeps a table of
    few narrow rows from becoming as many files as there are shuffle partitions.
    """
    path = fresh_path(df.sparkSession, tag)
    if rows is not None:
        df = df.coalesce(max(8, -(-rows // ROWS_PER_FILE)))
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*written: DataFrame) -> None:
    """Delete tables that ``materialize`` returned and nothing reads any more; other DataFrames are left alone."""
    for df in written:
        path = getattr(df, "_written_to", None)
        if path:
            remove(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more.

    Its cleaner acts when the driver collects garbage, which may else be long
    after the next stage has filled the disks.
    """
    gc.collect()
    spark._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder through Hadoop's file system."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class _Pass:
    """A mapInArrow function that hands freed memory back to the system after its task.

    Workers live on from stage to stage; else each would keep its peak.
    """

    def __init__(self, function):
        self.function = function

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from self.function(batches)
        finally:
            trim()


def trim() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library frees by its own rules
        pass


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow`` by workers that keep no memory beyond their task.

    Where the session has Spark's own bound of a batch's bytes, it gets a lower
    one from then on: passes cut batches further, and a large one is held
    several times in an executor's memory outside the heap.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH, None) == _SPARKS_OWN:
        conf.set(_BATCH, BATCH_BYTES)
    return df.mapInArrow(_Pass(function), schema)


def bounded(keys: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame | None:
    """``keys``, a few narrow columns, to be broadcast where a count shows ``rows`` at most; else None."""
    return F.broadcast(keys) if keys.limit(rows + 1).count() <= rows else None


def hot_keys(counts: DataFrame, keys: list[str], count: str = "count") -> DataFrame:
    """The keys of ``counts`` that have more than one in ``HOT_SHARES`` of all rows, to be broadcast: fewer than that."""
    total = counts.agg(F.sum(count)).first()[0] or 0
    return F.broadcast(counts.where(F.col(count) > max(1, total // HOT_SHARES)).select(*keys))


def join_spread(rows: DataFrame, facts: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """Inner join of ``rows`` with ``facts``, which has a row for each key.

    Rows of ``hot`` keys stay where they are and meet their facts, as many rows
    as hot keys, by broadcast; only the others are dealt out by key.
    """
    cold = rows.join(hot, keys, "left_anti").join(facts, keys)
    few = F.broadcast(facts.join(hot, keys, "left_semi"))
    return cold.unionByName(rows.join(few, keys).select(*cold.columns))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls become empty strings."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Arrow list column of consecutive slices of ``values``."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def in_parts(batch: pa.RecordBatch, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """A computed batch of narrow rows as several: Spark's side of a pass takes a message into one buffer."""
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def slices(batch: pa.RecordBatch, column: str, target: int = 1 << 20, rows: int = 2048):
    """Cut a record batch into runs of at most ``rows`` rows with about ``target`` text bytes."""
    at = batch.schema.get_field_index(column)
    _, offsets = string_buffers(batch.column(at))
    n, lo = batch.num_rows, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + target, side="right")) - 1
        hi = min(n, lo + rows, max(lo + 1, hi))
        yield batch.slice(lo, hi - lo)
        lo = hi
