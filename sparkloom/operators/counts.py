"""Dashboard counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def monitoring(df: DataFrame, columns: dict[str, str], *by: Column) -> DataFrame:
    """Rows that have each column, of all or ``by`` some columns, in one pass."""
    return df.groupBy(*by).agg(*[F.count(c).alias(name) for name, c in columns.items()])


def label_counts(df: DataFrame, host: str, labels: str, sep: str = ",") -> DataFrame:
    """(host, label, n) for rows with several labels in one field."""
    rows = df.select(F.col(host).alias("host"), F.explode(F.split(labels, sep)).alias("label"))
    return rows.groupBy("host", "label").agg(F.count("*").alias("n"))


def label_pivot(counts: DataFrame, labels: list[str]) -> DataFrame:
    """A row per host and a column per label."""
    return counts.groupBy("host").pivot("label", labels).agg(F.sum("n")).na.fill(0)


def sentiment_counts(df: DataFrame, host: str, label: str, sentiment: str, kinds: list[str], sep: str = ",") -> DataFrame:
    """A row per host and label and a column per sentiment."""
    rows = df.select(F.col(host).alias("host"), F.explode(F.split(label, sep)).alias("label"), F.col(sentiment).alias("sentiment"))
    return rows.groupBy("host", "label").pivot("sentiment", kinds).agg(F.count(F.lit(1))).na.fill(0, kinds)
