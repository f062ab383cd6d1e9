"""Registry of contract queries: name -> (spark builder, DuckDB oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyledger.plans.oracle_fixtures import with_fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, fixtures: tuple[str, ...] = ()):
    """Register a query builder; ``sql`` (DuckDB) is its independent oracle.

    Queries without ``sql`` are checked on row counts only (catalog output,
    random ciphertext and the like).
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_fixtures(sql, *fixtures)
        return fn
    return deco
