"""Term features in long format (document, term, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.sources.workspace import bounded, written


def term_rows(df: DataFrame, keys: str | list[str], terms: Column) -> DataFrame:
    """(keys, term) of every non-empty term of every row."""
    keys = [keys] if isinstance(keys, str) else keys
    return df.select(*keys, F.explode(terms).alias("term")).where("term <> ''")


def term_frequency(rows: DataFrame, keys: str | list[str], count: str | None = None) -> DataFrame:
    """How often each term occurs by keys; ``count`` names a column of frequencies to add up instead of rows."""
    keys = [keys] if isinstance(keys, str) else keys
    return rows.groupBy(*keys, "term").agg((F.sum(count) if count else F.count("*")).alias("tf"))


def document_frequency(docs: DataFrame, terms: Column, least: int = 1) -> DataFrame:
    """Terms with the number of rows of ``docs`` that have them, from ``least`` on.

    A row's terms are made distinct in place, so only partial counts are shuffled.
    """
    rows = docs.select(F.explode(F.array_distinct(terms)).alias("term")).where("term <> ''")
    return rows.groupBy("term").agg(F.count("*").alias("df")).where(F.col("df") >= least)


def inverse_frequency(docs: DataFrame, terms: Column, least: int) -> DataFrame:
    """ln((m + 1) / (df + 1)) of terms in ``least`` rows or more; m counts rows with terms.

    One pass over ``docs``: a row that has terms also counts for the empty term,
    whose number is m.  The frequent terms are written, so ``docs`` is read once
    however often the result is.
    """
    rows = docs.select(F.array_distinct(terms).alias("terms"))
    each = F.when(F.exists("terms", lambda w: w != ""), F.array_append(F.array_remove("terms", F.lit("")), F.lit("")))
    counts = rows.select(F.explode(each).alias("term")).where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("df"))
    kept, _ = written(counts.where((F.col("df") >= least) | (F.col("term") == "")), "df")
    first = kept.where("term = ''").first()
    m = first.df if first else 0
    return kept.where("term <> ''").select("term", "df", F.log(F.lit(m + 1.0) / (F.col("df") + 1.0)).alias("idf"))


def tfidf(frequency: DataFrame, idf: DataFrame, key: str) -> DataFrame:
    """tf * idf of the terms that have an idf; a table of few terms goes to the frequencies, which stay where they are."""
    return frequency.join(bounded(idf), "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("value"))


def combine(parts: list[DataFrame], keys: list[str], value: str = "value") -> DataFrame:
    """Element-wise sum of feature tables; old state and new rows alike."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy(*keys).agg(F.sum(value).alias(value))


def top(df: DataFrame, key: str, n: int, value: str = "value") -> DataFrame:
    """The ``n`` largest values of each key, ties by term."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(value), "term"))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def term_cloud(frequency: DataFrame, title: str, idf: DataFrame, n: int = 100, state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(top terms of each title, new state): title frequencies weighed by the documents' idf, added to the state."""
    values = tfidf(frequency, idf, title)
    total = combine([values, state], [title, "term"]) if state is not None else values
    return top(total, title, n), total


def cloud_of_all(clouds: DataFrame, n: int = 100) -> DataFrame:
    """Top terms over the titles' already cut clouds."""
    return clouds.groupBy("term").agg(F.sum("value").alias("value")).orderBy(F.desc("value"), "term").limit(n)
