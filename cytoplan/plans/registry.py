"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .roles import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(roles: str = "", body: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with its oracle if SQL can express it."""

    def register(f: Query) -> Query:
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"two queries are named {key}")
        QUERIES[key] = f
        if body:
            SQL[key] = sql(roles, body)
        return f

    return register
