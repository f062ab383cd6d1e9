"""Queries of this subpackage: name -> builder (spark, sf_dir) -> DataFrame, and DuckDB SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query builder under ``name``; ``sql`` is its DuckDB oracle, where SQL can express it."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark, sf_dir: str, name: str):
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
