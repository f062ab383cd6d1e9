"""Compare a registered Spark query with its DuckDB oracle (order-insensitive)."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

from pyspark.sql import SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

from skyledger.plans import ORACLE, QUERIES
from skyledger.sources.fixtures import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):  # exact: both engines must give the same double
        if math.isnan(v):
            return None
        return v + 0.0  # -0.0 == 0.0
    if isinstance(v, Decimal):
        return float(v) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if isinstance(v, bytes | bytearray):
        return bytes(v).hex()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark: SparkSession, name: str, sf_dir: str, con=None) -> dict:
    df = QUERIES[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = _rows(s_cols, [tuple(r) for r in df.collect()])
    res = {"query": name, "spark_rows": len(s_rows)}
    if name not in ORACLE:
        res["status"] = "rows-only"
        return res
    con = con or duckdb_connection(sf_dir)
    tbl = con.sql(ORACLE[name]).to_arrow_table()
    d_cols = tbl.column_names
    d_rows = _rows(d_cols, [tuple(r.values()) for r in tbl.to_pylist()])
    res["oracle_rows"] = len(d_rows)
    res["columns_match"] = sorted(s_cols) == sorted(d_cols)
    s_types = {f.name: str(f.type) for f in to_arrow_schema(df.schema)}
    d_types = {f.name: str(f.type) for f in tbl.schema}
    res["types_match"] = s_types == d_types
    if not res["types_match"]:
        res["type_diff"] = {k: (s_types.get(k), d_types.get(k)) for k in set(s_types) | set(d_types)
                            if s_types.get(k) != d_types.get(k)}
    res["values_match"] = s_rows == d_rows
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = sorted(s_cols), sorted(d_cols)
    elif not res["values_match"]:
        diff_s = [r for r in s_rows if r not in set(d_rows)][:3]
        diff_d = [r for r in d_rows if r not in set(s_rows)][:3]
        res["spark_only"], res["oracle_only"] = diff_s, diff_d
    res["status"] = "ok" if res["columns_match"] and res["values_match"] and res["types_match"] else "MISMATCH"
    return res
