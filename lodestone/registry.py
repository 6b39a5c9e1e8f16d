"""Registry of the core queries: name -> callable, and name -> equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, into: dict | None = None, sql_into: dict | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL if there is one."""

    def register(f: Query) -> Query:
        (QUERIES if into is None else into)[f.__name__] = f
        if sql:
            (SQL if sql_into is None else sql_into)[f.__name__] = sql
        return f

    return register
