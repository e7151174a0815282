"""Reply trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.sources.workspace import remove, written


def replies(df: DataFrame, parent: str, of: DataFrame, of_id: str, since: Column | None = None, addressee: Column | None = None) -> DataFrame:
    """Rows that answer one of the given rows, optionally from a time on (``since``, a condition) and to the right user (``addressee``, likewise)."""
    for condition in (since, addressee):
        if condition is not None:
            df = df.where(condition)
    return df.join(of.select(F.col(of_id).alias(parent)), parent, "left_semi")


def tree(df: DataFrame, key: str, parent: str) -> DataFrame:
    """(child, parent, base, depth) of all descendants of the roots (rows without parent).

    Every row knows an ancestor and takes over that one's in each round, so the
    distance doubles and a chain of any length takes its logarithm in rounds.
    Rows whose ancestors end at no root (a missing parent, a cycle) are left
    out; where ids repeat there is a row for each way up.
    """
    spark, up = df.sparkSession, F.col("parent")
    rows = df.select(F.col(key).alias("child"), F.col(parent).alias("parent")).where(F.col("child").isNotNull())
    state, path = written(rows.select("child", "parent", F.coalesce(up, F.col("child")).alias("base"), F.when(up.isNull(), 0).otherwise(1).alias("depth"), up.isNull().alias("done")), "replies")
    n, reach = state.count(), 1
    while reach <= n and not state.where(~F.col("done")).isEmpty():
        above = state.select(F.col("child").alias("base"), F.col("base").alias("next"), F.col("depth").alias("more"), F.col("done").alias("ends"))
        moved = state.where(~F.col("done")).join(above, "base").select("child", "parent", F.col("next").alias("base"), (F.col("depth") + F.col("more")).alias("depth"), F.col("ends").alias("done"))
        old = path
        state, path = written(state.where("done").unionByName(moved), "replies")
        remove(spark, old)
        reach *= 2
    return state.where("done AND depth > 0").select("child", "parent", "base", "depth")


def with_base(rows: DataFrame, attributes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Tree rows with the attributes of child, parent and root."""
    out = rows
    for side in ("child", "parent", "base"):
        named = attributes.select(F.col(key).alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])
        out = out.join(named, side)
    return out
