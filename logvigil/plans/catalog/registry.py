"""Registry of named queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..views import view, view_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its oracle where SQL can express it."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def with_view(name: str, body: str) -> str:
    """Oracle text over a derived view."""
    return f"with {name} as ({view_sql(name, 'duckdb')}) {body}"


__all__ = ["QUERIES", "ORACLE", "query", "with_view", "view", "view_sql"]
