"""All queries of the engine by name, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under its name."""

    def put(f: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return put
