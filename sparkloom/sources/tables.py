"""Scans: column-exists predicates, text and training files, state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkloom.schema import TRAINING

#: Words of a list that becomes part of a plan.
MOST_WORDS = 100_000


def scan(df: DataFrame, exists: list[str], missing: list[str] = (), columns: list[str] | None = None) -> DataFrame:
    """Rows that have all ``exists`` and none of ``missing`` columns; all of ``columns`` are required too.

    Plain null tests, so that they and the projection reach the file scan.
    """
    for c in [*exists, *(columns or [])]:
        df = df.where(F.col(c).isNotNull())
    for c in missing:
        df = df.where(F.col(c).isNull())
    return df.select(*columns) if columns else df


def unprocessed(df: DataFrame, key: str, exist: str, not_exist: str) -> DataFrame:
    """(key, value) of rows that have one column and not yet another."""
    return scan(df, [exist], [not_exist]).select(key, exist)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def training_file(spark: SparkSession, path: str) -> DataFrame:
    """label, url, terms of a tab-separated training file; short lines and lines without terms are dropped."""
    df = spark.read.schema(TRAINING).option("sep", "\t").csv(path)
    return df.where("label is not null and terms is not null")


def split_lines(df: DataFrame, line: str, sep: str, names: list[str]) -> DataFrame:
    """Fields by position; lines with fewer than ``len(names)`` fields are dropped."""
    parts = F.split(F.col(line), sep)
    return df.where(F.size(parts) >= len(names)).select("*", *[parts[i].alias(n) for i, n in enumerate(names)])


def word_list(spark: SparkSession, path: str) -> list[str]:
    """The words of a small file, separated by commas or lines (a stop list, an exclusion list, search keywords)."""
    words = F.explode(F.split("value", "[,\n]")).alias("w")
    rows = spark.read.text(path).select(words).select(F.trim("w").alias("w")).where("w <> ''").distinct().orderBy("w").limit(MOST_WORDS + 1).collect()
    if len(rows) > MOST_WORDS:
        raise ValueError(f"{path} has more than {MOST_WORDS} words: join it as a table")
    return [r.w for r in rows]


def word_table(spark: SparkSession, path: str) -> DataFrame:
    """(word) of a file of any size, separated by commas or lines."""
    words = F.explode(F.split("value", "[,\n]")).alias("word")
    return spark.read.text(path).select(words).select(F.trim("word").alias("word")).where("word <> ''")


def map_table(spark: SparkSession, path: str) -> DataFrame:
    """(word, to) of the ``KEY:expansion`` entries of a file of any size."""
    at = F.instr("word", ":")
    return word_table(spark, path).where(at > 1).select(F.substring("word", F.lit(1), at - 1).alias("word"), F.substring("word", at + 1, F.length("word")).alias("to"))


def word_map(spark: SparkSession, path: str) -> dict[str, str]:
    """``KEY:expansion`` entries of a small file, separated by commas or lines; the first of a repeated key."""
    return {k: v for k, v in (x.split(":", 1) for x in reversed(word_list(spark, path)) if ":" in x)}


def lexicon_file(spark: SparkSession, path: str) -> DataFrame:
    """pos, id, pos_score, neg_score, terms, gloss of a tab-separated lexicon; comment lines and lines without six fields are dropped."""
    parts = F.split("value", "\t", -1)
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).where(F.size(parts) == 6)
    names = ("pos", "id", "pos_score", "neg_score", "terms", "gloss")
    return rows.select(*[parts[i].alias(n) for i, n in enumerate(names)]).withColumns({n: F.col(n).try_cast("double") for n in ("pos_score", "neg_score")}).dropna(subset=["pos_score", "neg_score"])


def lookup(df: DataFrame, key: str, ids: list) -> DataFrame:
    """Rows with one of a few given ids."""
    return df.where(F.col(key).isin(list(ids)))


def state(spark: SparkSession, path: str, schema: str | StructType, run: str = "") -> DataFrame:
    """Latest version of a saved state that ``run`` did not write; empty with its schema when there is none."""
    done = [v for v in versions(spark, path) if not run or v[1] != run]
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_path(path, *done[-1]))


def version_path(path: str, n: int, run: str = "") -> str:
    return f"{path}/v={n}" + (f".{run}" if run else "")


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, run) of the versions that were written completely."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for s in fs.listStatus(root):
        name = s.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            n, _, run = name[2:].partition(".")
            found.append((int(n), run))
    return sorted(found)
