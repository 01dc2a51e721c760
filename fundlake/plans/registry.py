"""Registry of the named queries over the driver tables and their DuckDB
oracle SQL. A query without oracle SQL is checked by row count only."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(name: str, sql: str | None = None, covers: str = ""):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        COVERS[name] = covers
        return fn
    return register
