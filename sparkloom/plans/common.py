"""What the query modules share: tables, a registry, pieces of SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Registry(dict):
    """name -> query; ``@registry.add(sql)`` also files the SQL equivalent under the same name."""

    def __init__(self):
        super().__init__()
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def put(query):
            self[query.__name__] = query
            if sql is not None:
                self.sql[query.__name__] = sql
            return query

        return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_terms(text: str = "text") -> str:
    """DuckDB: lower-case words of a-z and digits."""
    return f"list_filter(list_transform(string_split_regex({text}, '\\s+'), lambda w: regexp_replace(lower(w), '[^a-z0-9]', '', 'g')), lambda w: w <> '')"


def sql_words(text: str = "text") -> str:
    return f"list_filter(string_split_regex({text}, '\\s+'), lambda w: w <> '')"


def sql_case(words: dict[str, str], w: str, other: str) -> str:
    return f"CASE {w} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in words.items()) + f" ELSE {other} END"


def sql_list(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"
