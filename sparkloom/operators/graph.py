"""Interaction networks per title: node sizes and directed edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.sources.sinks import numbered_rows


def nodes(df: DataFrame, title: str, user: str, reply_to: str) -> DataFrame:
    """(title, node, size): how often a name occurs as author or addressee; no title is ``all``."""
    names = F.explode(F.array(user, reply_to)).alias("node")
    rows = df.select(F.coalesce(F.col(title), F.lit("all")).alias("title"), names).where("node is not null")
    return rows.groupBy("title", "node").agg(F.count("*").alias("size"))


def edges(df: DataFrame, title: str, user: str, reply_to: str) -> DataFrame:
    rows = df.select(F.coalesce(F.col(title), F.lit("all")).alias("title"), F.col(user).alias("node1"), F.col(reply_to).alias("node2"))
    return rows.where("node1 is not null and node2 is not null").distinct()


def merge_nodes(*parts: DataFrame) -> DataFrame:
    """Sizes added by title and node."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy("title", "node").agg(F.sum("size").alias("size"))


def merge_edges(*parts: DataFrame) -> DataFrame:
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.distinct()


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows of each title numbered from 0, for its file, in ``order``."""
    return numbered_rows(df, order, ["title"])
