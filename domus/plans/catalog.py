"""Query catalog: one Spark callable and (where SQL can express it) one DuckDB oracle per
inventory name. Each callable takes (spark, sf_dir) and returns a DataFrame over the whole
test tables. Floats are rounded identically on both sides (prices 4 places, others 6).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query (and its oracle SQL, if any) to the catalog."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from domus.plans import (  # noqa: F401
        q_contract,
        q_drift,
        q_location,
        q_monitoring,
        q_registry,
        q_sources,
        q_streaming,
        q_training,
    )
