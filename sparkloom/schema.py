"""Logical tables and their columns.

A wide table has a row key and one nullable string column per cell; a role maps
the logical column names of a job to the physical ones of a source type.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

CRAWL = T.StructType([T.StructField(n, T.StringType()) for n in ("row_key", "text", "cleaned", "classification", "classified", "termcloud_status", "host", "time_ms", "user_id", "user_name", "reply_to")])
COMMENT = T.StructType([T.StructField(n, T.StringType()) for n in ("row_key", "text", "user", "depth", "reply_to", "base_id", "classification", "sentiment", "url", "domain")])
TRAINING = T.StructType([T.StructField(n, T.StringType()) for n in ("label", "url", "terms")])
NODES = "title string, node string, size bigint"
EDGES = "title string, node1 string, node2 string"


@dataclass(frozen=True)
class Role:
    """Physical column of each logical column of one source type."""

    kind: str
    columns: dict[str, str] = field(default_factory=dict)

    def rename(self, df):
        """``df`` with the logical names of this role; unknown columns raise."""
        return df.select(*[df[physical].alias(logical) for logical, physical in self.columns.items()])


def table_name(user: str, task: str, suffix: str) -> str:
    """Name of a task's table."""
    return f"{user}_{task}_{suffix}".replace("-", "_")
