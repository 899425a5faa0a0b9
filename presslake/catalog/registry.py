"""Names of the registered queries, their Spark form and their SQL form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: list[str] | None = None):
    """Register a query; `sql` follows the given common table expressions."""

    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = (f"WITH {', '.join(ctes)} " if ctes else "") + sql
        return run

    return add
