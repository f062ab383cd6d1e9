"""Projection language over nested resource records.

flatten (array-in-array), conjunctive containment filters, exists probes,
path projection, keyed lookup in key/value item lists, sorted listings and
"latest n" — all as built-in expressions (explode / higher-order functions),
so filters on parent columns still reach the scan below the Generate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_json(df: DataFrame, column: str, schema: T.DataType | str, alias: str = "doc") -> DataFrame:
    """Parse a JSON text column with an explicit schema (no inference pass)."""
    return df.withColumn(alias, F.from_json(F.col(column), schema))


def flatten_bindings(policies: DataFrame, keep: tuple[str, ...] = ("resource",)) -> DataFrame:
    """bindings[].members -> one row per (binding, member), parent columns kept."""
    b = policies.select(*keep, F.explode("bindings").alias("b"))
    return b.select(*keep, F.col("b.role").alias("role"), F.explode("b.members").alias("member"))


def filter_contains(df: DataFrame, **substrings: str) -> DataFrame:
    """``a:x AND b:y`` — each named column must contain its substring."""
    cond = F.lit(True)
    for col, sub in substrings.items():
        cond = cond & F.col(col).contains(sub)
    return df.where(cond)


def has_binding(policies: DataFrame, role: str, member_substring: str) -> DataFrame:
    """Per resource: does any binding give `role` to a member containing the text?

    Evaluated inside each document with higher-order functions: no explode,
    no shuffle.
    """
    hit = F.exists("bindings", lambda b: (b["role"] == F.lit(role)) & F.exists(
        b["members"], lambda m: m.contains(member_substring)))
    return policies.select("resource", hit.alias("has_role"))


def any_match(df: DataFrame, cond: Column) -> bool:
    """``grep -q``: does any row satisfy the condition? Stops at the first match
    (``limit(1)``), so only as much input is read as needed."""
    return len(df.where(cond).limit(1).take(1)) > 0


def project_paths(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Nested paths -> flat columns: {alias: 'a.b.c'}."""
    return df.select(*[F.col(p).alias(a) for a, p in paths.items()])


def lookup(items: Column, key: str) -> Column:
    """Value for `key` in an array<struct<key, value>> item list (NULL if absent; the first
    one if the key is repeated)."""
    return F.try_element_at(F.filter(items, lambda i: i["key"] == F.lit(key)), F.lit(1))["value"]


def map_lookup(df: DataFrame, items_path: str, keys: dict[str, str],
               keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*keep, *[lookup(F.col(items_path), k).alias(a) for a, k in keys.items()])


def sort_listing(df: DataFrame, by: str, tie: str = "name") -> DataFrame:
    """`--sort-by` — ascending by one field, ties by name."""
    return df.orderBy(F.col(by).asc(), F.col(tie).asc())


def latest_n(df: DataFrame, ts: str, n: int, tie: str) -> DataFrame:
    """`--limit n` over a listing, newest first (top-k; no global sort)."""
    return df.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(n)
