"""Contract queries: load, describe, schema, statistics and CSV round trip."""

from __future__ import annotations

from skyledger.operators import billing as B
from skyledger.plans.billing import _FLAT, _Q1
from skyledger.plans.loaded import billing_table_name as _loaded
from skyledger.plans.loaded import load_billing as _load
from skyledger.plans.loaded import load_billing_avro as _load_avro
from skyledger.plans.registry import register
from skyledger.session import scratch_path
from skyledger.sources import catalog as C


@register("load_table", f"SELECT {_FLAT} FROM billing", ("billing",))
def load_table(spark, sf):
    return B.flatten(spark.table(_load(spark, sf)))


@register("load_avro", f"SELECT {_FLAT} FROM billing", ("billing",))
def load_avro(spark, sf):
    return B.flatten(spark.table(_load_avro(spark, sf)))


@register("describe_table")
def describe_table(spark, sf):
    return C.describe_table(spark, _loaded(spark, sf))


@register("schema_fields")
def schema_fields(spark, sf):
    return C.schema_frame(spark, spark.table(_loaded(spark, sf)))


_TEXTS = ("billing_account_id", "project_id", "project_name", "service_description", "sku_description", "country",
          "currency", "usage_unit", "pricing_unit")
_NUMBERS = ("currency_conversion_rate", "usage_amount", "usage_end_time", "order_key", "line_number", "part_key",
            "supp_key")
_BYTES = " + ".join([*(f"COALESCE(strlen({c}) + 2, 0)" for c in _TEXTS),
                     *(f"CASE WHEN {c} IS NULL THEN 0 ELSE 8 END" for c in _NUMBERS),
                     "CASE WHEN cost IS NULL THEN 0 ELSE 16 END"])


@register("table_stats", f"""
SELECT COUNT(*) AS num_rows, CAST(COALESCE(SUM({_BYTES}), 0) AS BIGINT) AS num_bytes FROM billing""", ("billing",))
def table_stats(spark, sf):
    return C.table_stats(spark, _loaded(spark, sf)).select("num_rows", "num_bytes")


@register("csv_roundtrip", f"SELECT {_Q1}, usage_end_time FROM billing", ("billing",))
def csv_roundtrip(spark, sf):
    flat = B.flatten(spark.table(_loaded(spark, sf)), B.QUERY1_FIELDS + ["usage_end_time"])
    path = C.write_csv(flat, scratch_path(spark, "csv"))
    return C.read_csv(spark, path, flat.schema)
