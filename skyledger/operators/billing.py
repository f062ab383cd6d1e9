"""Billing-export analytics: counts, thresholds, latest charges, per-service totals.

Money stays DECIMAL(18,2) through every sum (exact and independent of
partitioning); results are cast to DOUBLE only at the very end.
Every ORDER BY ... LIMIT carries the line-item tie key so the chosen rows
do not depend on scan order. Filters are written on top-level columns and
reach the parquet scan; struct fields are pruned to the ones used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output aliases for nested fields (two structs both end in `description`).
FLAT_FIELDS = [
    ("billing_account_id", "billing_account_id"),
    ("project.id", "project_id"),
    ("project.name", "project_name"),
    ("service.description", "service_description"),
    ("sku.description", "sku_description"),
    ("location.country", "country"),
    ("cost", "cost"),
    ("currency", "currency"),
    ("currency_conversion_rate", "currency_conversion_rate"),
    ("usage.amount", "usage_amount"),
    ("usage.unit", "usage_unit"),
    ("usage.pricing_unit", "pricing_unit"),
    ("usage_end_time", "usage_end_time"),
]
_ALIAS = dict(FLAT_FIELDS)

QUERY1_FIELDS = ["billing_account_id", "project.id", "project.name", "service.description",
                 "currency", "currency_conversion_rate", "cost", "usage.amount",
                 "usage.pricing_unit"]
DETAIL_FIELDS = ["service.description", "sku.description", "location.country", "cost",
                 "project.id", "project.name", "currency", "currency_conversion_rate",
                 "usage.amount", "usage.unit"]

TIE_KEY = ["line_item.order_key", "line_item.line_number", "line_item.part_key",
           "line_item.supp_key", "usage.amount", "usage_end_time"]


def _out(path: str) -> Column:
    c = F.col(path)
    if path == "cost":
        c = c.cast("double")
    return c.alias(_ALIAS[path])


def flatten(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Project nested paths to uniquely named flat columns."""
    return df.select(*[_out(p) for p in (fields or [f for f, _ in FLAT_FIELDS])])


def _tie() -> list[Column]:
    return [F.col(c).asc() for c in TIE_KEY]


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return flatten(df.orderBy(*_tie()).limit(n))


def rows_with_cost(df: DataFrame, threshold: float = 0) -> DataFrame:
    return df.where(F.col("cost") > threshold).agg(F.count(F.lit(1)).alias("records_with_cost"))


def sample_with_cost(df: DataFrame, n: int = 10, threshold: float = 0) -> DataFrame:
    return flatten(df.where(F.col("cost") > threshold).orderBy(*_tie()).limit(n))


def all_records(df: DataFrame) -> DataFrame:
    """Query 1: nine columns, five of them from structs, whole table."""
    return flatten(df, QUERY1_FIELDS)


def latest(df: DataFrame, n: int = 100, threshold: float = 0) -> DataFrame:
    """Query 2: the n latest charges above the threshold (top-k, no full sort)."""
    return flatten(df.where(F.col("cost") > threshold)
                   .orderBy(F.col("usage_end_time").desc(), *_tie()).limit(n), DETAIL_FIELDS)


def over_threshold(df: DataFrame, threshold: float = 10) -> DataFrame:
    """Query 3: all charges above the threshold."""
    return flatten(df.where(F.col("cost") > threshold), DETAIL_FIELDS)


def records_by(df: DataFrame, path: str, threshold: float | None = None) -> DataFrame:
    """Queries 4-6: record count per nested field, most records first."""
    if threshold is not None:
        df = df.where(F.col("cost") > threshold)
    return (df.groupBy(F.col(path).alias(_ALIAS[path]))
            .agg(F.count(F.lit(1)).alias("billing_records"))
            .orderBy(F.col("billing_records").desc(), F.col(_ALIAS[path])))


def cost_by_service(df: DataFrame) -> DataFrame:
    """Query 7: ROUND(SUM(cost), 2) per service, highest first."""
    return (df.groupBy(F.col("service.description").alias("service_description"))
            .agg(F.round(F.sum("cost"), 2).cast("double").alias("total_cost"))
            .orderBy(F.col("total_cost").desc(), F.col("service_description")))


def top1(df: DataFrame, value: str, key: str) -> DataFrame:
    """The first row of an analysis: highest value, ties broken by key."""
    return df.orderBy(F.col(value).desc(), F.col(key).asc()).limit(1)


def top_service_by_cost(df: DataFrame) -> DataFrame:
    return top1(cost_by_service(df), "total_cost", "service_description")
