"""Registry of queries and the SQL text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bindings import Tables, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``build(tables) -> DataFrame`` under a name.

    In ``sql``, the bound tables (``submissions``, ``comments``, ...) are
    prefixed as common table expressions where they are used.
    """

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[name] = with_tables(sql)
        return build

    return register
