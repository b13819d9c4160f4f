"""Checked queries: a Spark callable beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def checked(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL equivalent."""

    def register(query: Query) -> Query:
        name = query.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = query
        ORACLES[name] = sql.strip()
        return query

    return register
