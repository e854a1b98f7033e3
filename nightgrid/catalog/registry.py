"""Registration of queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a query, and the SQL that computes the same rows if there is any."""

    def register(build: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = build
        if sql is not None:
            SQL[key] = sql
        return build

    return register
