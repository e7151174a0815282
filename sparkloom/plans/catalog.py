"""Registry of the engine's queries and of their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkloom.plans import cleaning, features, jobruns, relations, rows, stateful

MODULES = (rows, cleaning, features, relations, stateful, jobruns)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLES: dict[str, str] = {k: q for m in MODULES for k, q in m.ORACLES.items()}
