"""Session and engine configuration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class EngineConfig:
    """Operational constants of the analytics jobs."""

    min_doc_freq: int = 100
    top_terms: int = 100
    svm_iterations: int = 100
    margin: float = 1.0
    none_label: str = "none"
    host_interval_ms: int = 3_600_000
    post_interval_ms: int = 86_400_000
    majority: float = 0.5
    search_limit: int = 5000
    stream_interval: str = "1 second"
    term_delimiter: str = ","
    field_delimiter: str = "\t"


def session(app: str = "sparkloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC times; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC"}
    for k, v in (defaults | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
