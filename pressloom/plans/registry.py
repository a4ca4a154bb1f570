"""Named queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``query(spark, folder)`` under ``name`` with its SQL, where there is one."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return add
