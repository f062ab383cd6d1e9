"""Size checks before broadcasting or embedding a side (no Spark job needed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


UNKNOWN_SIZE = 1 << 62


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a plan (exact for scans and local data).

    Where the estimate is not reachable (e.g. a Spark Connect client) the size
    counts as unknown, so nothing is broadcast on its account.
    """
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # no JVM handle on this client
        return UNKNOWN_SIZE


def bounded_broadcast(df: DataFrame, max_bytes: int) -> DataFrame:
    """Broadcast a side only when its estimated size is at most ``max_bytes``.

    Otherwise (too large, or of unknown size) the side is returned as is, and
    the join falls back to a shuffle join that AQE may still turn into a
    broadcast once the real size is known at run time.
    """
    return F.broadcast(df) if plan_bytes(df) <= max_bytes else df


def sql_literal(v, dt) -> str:
    """A Python value as a Spark SQL literal of type ``dt`` (strings escaped)."""
    from pyspark.sql import types as T

    if v is None:
        return f"CAST(NULL AS {dt.simpleString()})"
    if isinstance(dt, T.ArrayType):
        items = ", ".join(sql_literal(x, dt.elementType) for x in v)
        return f"CAST(array({items}) AS {dt.simpleString()})"
    if isinstance(dt, T.StructType):
        fields = ", ".join(f"'{f.name}', {sql_literal(v[f.name] if isinstance(v, dict) or hasattr(v, 'asDict') else v[i], f.dataType)}"
                           for i, f in enumerate(dt.fields))
        return f"named_struct({fields})"
    if isinstance(dt, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(dt, T.BooleanType):
        return "TRUE" if v else "FALSE"
    return f"CAST({v!r} AS {dt.simpleString()})"


def literal_array(spark, rows, schema: str):
    """A small fixed table as one array<struct> literal expression."""
    from pyspark.sql import types as T

    st = T._parse_datatype_string(schema)
    return F.expr("array(" + ", ".join(sql_literal(r, st) for r in rows) + ")")


def literal_table(spark, rows, schema: str) -> DataFrame:
    """A small fixed table as inline literals: the optimizer folds it into a
    local relation with an exact size, so size checks see its true bound
    (``createDataFrame`` over Python rows reports an unknown size). Built as
    one SQL expression, so it costs one call into the JVM."""
    return spark.range(1).select(F.inline(literal_array(spark, rows, schema)))
