"""Sinks: keyed upsert, surrogate keys, versioned state, text files."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.sources.tables import version_path, versions
from sparkloom.sources.workspace import remove, written


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Cells of ``new`` over those of ``old`` by key; a null or absent cell keeps the old value.

    Null keys are equal.  Rows of ``new`` that repeat a key are written one
    after another by ``order``, which is no cell then; without it, or where it
    is equal too, rows with different values in a cell are an error.  Keys are
    compared as one struct, so the rows lie for the join as they were grouped.
    ``KeyedTable`` keeps a table on disk and writes only what changes.
    """
    given = [c for c in new.columns if c not in keys and c != order]
    cells = [c for c in [*old.columns, *[c for c in given if c not in old.columns]] if c not in keys]
    clash = lambda c: F.raise_error(F.lit(f"rows of one key differ in {c} and no order says which is the last"))
    one = lambda c: F.when(F.min(c).eqNullSafe(F.max(c)), F.max(c)).otherwise(clash(c)).alias(f"_{c}")
    at = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    fresh = new.groupBy(at.alias("__new_key"), *[F.col(o).alias("_place") for o in [order] * bool(order)]).agg(*[one(c) for c in given], F.lit(True).alias("_new"))
    if order:
        last = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct("_place", c)))[c].alias(c)
        fresh = fresh.groupBy("__new_key").agg(*[last(f"_{c}") for c in given], F.lit(True).alias("_new"))
    both = old.withColumns({"_old": F.lit(True), "__old_key": at}).join(fresh, F.col("__old_key") == F.col("__new_key"), "full_outer")
    key = [F.when(F.col("_old"), F.col(k)).otherwise(F.col("__new_key")[f"k{i}"]).alias(k) for i, k in enumerate(keys)]

    def cell(c: str) -> Column:
        return F.coalesce(*[F.col(x) for x, df in ((f"_{c}", new), (c, old)) if c in df.columns]).alias(c)

    return both.select(*key, *[cell(c) for c in cells])


def numbered_rows(df: DataFrame, order: list[str], within: list[str] = (), name: str = "id") -> DataFrame:
    """``df`` with the place of each row, from 0, among the rows of the same ``within``.

    Rows are dealt out by ranges and written once with their place in their
    part; a count per part does the rest, so no group meets in one task.
    """
    by = [*within, *order]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    rows, _ = written(ranged, "numbered")
    parts = rows.groupBy(*within, "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first"))
    keys = {c: f"_{c}" for c in within}
    parts = parts.select(*[F.col(c).alias(k) for c, k in keys.items()], F.col("_part").alias("_at"), "_start")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()], F.col("_part") == F.col("_at"))
    return rows.join(parts, same).select(*df.columns, (F.col("_start") + F.col("_row")).cast("bigint").alias(name))


def with_keys(dimension: DataFrame, new: DataFrame, natural: list[str], key: str = "id") -> DataFrame:
    """``dimension`` with a surrogate key for every new natural key; new keys follow the largest one."""
    fresh = new.select(*natural).distinct().join(dimension.select(*natural), natural, "left_anti")
    start = dimension.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint")).first()[0]
    numbered = numbered_rows(fresh, natural, name="_id").select((F.col("_id") + F.lit(start) + 1).alias(key), *natural)
    return dimension.select(key, *natural).unionByName(numbered)


def save_state(df: DataFrame, path: str, run: str = "", keep: int = 2) -> str:
    """Write the next version of a state; readers see it once it is complete.

    A ``run`` that is repeated writes its own version again.  Of older versions the last ``keep`` stay.
    """
    spark = df.sparkSession
    done = [v for v in versions(spark, path) if not run or v[1] != run]
    target = version_path(path, (done[-1][0] + 1) if done else 1, run)
    df.write.mode("overwrite").parquet(target)
    for n, r in done[: max(0, len(done) + 1 - keep)]:
        remove(spark, version_path(path, n, r))
    return target


def single_file(df: DataFrame, path: str, sep: str = "\t") -> None:
    """One text file, written as parts by all tasks and joined in the file system.

    A store that joins files by their blocks (``concat`` of HDFS) moves no
    data; elsewhere the parts are copied one after another through a buffer.
    """
    spark = df.sparkSession
    parts_path = f"{path}.parts-{uuid.uuid4().hex[:12]}"
    df.write.option("sep", sep).csv(parts_path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root, target = jvm.org.apache.hadoop.fs.Path(parts_path), jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    parts = sorted((s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("part-") and s.getLen()), key=str)
    joined = jvm.org.apache.hadoop.fs.Path(root, "_joined")
    fs.create(joined, True).close()
    if parts and fs.getScheme() == "hdfs":
        array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
        for i, p in enumerate(parts):
            array[i] = p
        fs.concat(joined, array)
    elif parts:
        out = fs.create(joined, True)
        for p in parts:
            source = fs.open(p)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
            source.close()
        out.close()
    fs.delete(target, True)
    fs.rename(joined, target)
    fs.delete(root, True)


def named_files(df: DataFrame, path: str, run: str) -> None:
    """Parquet files in ``path`` whose names begin with ``run`` and the number of their part; the folder may have others."""
    spark = df.sparkSession
    aside = f"{path}.{run}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(aside)
    path_of, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    fs = path_of(path).getFileSystem(conf)
    fs.mkdirs(path_of(path))
    parts = sorted(s.getPath().getName() for s in fs.listStatus(path_of(aside)) if s.getPath().getName().startswith("part-"))
    for i, name in enumerate(parts):
        fs.rename(path_of(f"{aside}/{name}"), path_of(f"{path}/{run}-{i:05d}.parquet"))
    remove(spark, aside)


def files_by(df: DataFrame, title: str, path: str) -> None:
    """A folder of tab-separated files with header for every title."""
    df.write.mode("overwrite").partitionBy(title).option("sep", "\t").option("header", True).csv(path)


def create_table(spark: SparkSession, name: str, schema: str) -> None:
    """Create a Parquet table unless there is one."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet")


def table_has(spark: SparkSession, name: str, columns: list[str]) -> bool:
    return spark.catalog.tableExists(name) and set(columns) <= set(spark.table(name).columns)


def mark(df: DataFrame, key: str, status: str, value: str = "1") -> DataFrame:
    """(key, status) cells that say a row is processed."""
    return df.select(key, F.lit(value).alias(status))
