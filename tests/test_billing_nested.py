"""Edge frames for the billing queries and the nested-record projections."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from skyledger.operators import billing as B
from skyledger.operators import nested as N

SCHEMA = ("billing_account_id string, project struct<id:string,name:string>, "
          "service struct<description:string>, sku struct<description:string>, "
          "location struct<country:string>, cost decimal(18,2), currency string, "
          "currency_conversion_rate double, usage struct<amount:double,unit:string,pricing_unit:string>, "
          "usage_end_time timestamp_ntz, "
          "line_item struct<order_key:bigint,line_number:int,part_key:bigint,supp_key:bigint>")


def row(i, service, cost, ts):
    return ("a", ("p", "P"), (service,), ("sku",), ("US",), None if cost is None else Decimal(cost), "USD",
            1.0, (1.0, "u", "pu"), ts, (i, 1, 1, 1))


T0 = dt.datetime(2020, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_null_cost_is_not_counted(spark):
    df = frame(spark, [row(1, "S", "1.50", T0), row(2, "S", None, T0), row(3, "S", "0.00", T0)])
    assert B.rows_with_cost(df).first()["records_with_cost"] == 1
    assert B.cost_by_service(df).first()["total_cost"] == 1.5
    assert B.total_rows(df).first()["total_rows"] == 3


def test_equal_timestamps_at_the_limit_break_on_tie_key(spark):
    rows = [row(i, f"service {i}", "2.00", T0) for i in range(5, 0, -1)]
    got = B.latest(frame(spark, rows), 2)
    # the two lowest line-item keys win among equal timestamps
    assert sorted(r.service_description for r in got.collect()) == ["service 1", "service 2"]


def test_empty_input(spark):
    df = frame(spark, [])
    assert B.total_rows(df).first()["total_rows"] == 0
    assert B.cost_by_service(df).count() == 0
    assert B.top_service_by_cost(df).count() == 0


def test_duplicate_struct_field_names_are_aliased(spark):
    df = frame(spark, [row(1, "S", "1.00", T0)])
    cols = B.over_threshold(df, 0).columns
    assert "service_description" in cols and "sku_description" in cols
    assert len(cols) == len(set(cols))


def test_rounding_is_exact_in_decimal(spark):
    df = frame(spark, [row(i, "S", "0.10", T0) for i in range(3)])
    assert B.cost_by_service(df).first()["total_cost"] == 0.3


def test_flatten_filter_exists(spark):
    pol = spark.createDataFrame(
        [("r1", [("roles/viewer", ["user:a@x", "user:b@x"]), ("roles/owner", ["user:c@x"])]),
         ("r2", [])],
        "resource string, bindings array<struct<role:string,members:array<string>>>")
    flat = N.flatten_bindings(pol)
    assert flat.count() == 3
    hit = N.filter_contains(flat, member="b@x", role="viewer")
    assert [r.member for r in hit.collect()] == ["user:b@x"]
    has = {r.resource: r.has_role for r in N.has_binding(pol, "roles/viewer", "a@").collect()}
    assert has == {"r1": True, "r2": False}
    assert N.any_match(flat, F.col("role") == "roles/owner")
    assert not N.any_match(flat, F.col("role") == "roles/editor")


def test_keyed_lookup_missing_key_is_null(spark):
    df = spark.createDataFrame([([("zone", "us-east1-b")],)], "items array<struct<key:string,value:string>>")
    r = df.select(N.lookup(F.col("items"), "zone").alias("z"), N.lookup(F.col("items"), "x").alias("x")).first()
    assert r.z == "us-east1-b" and r.x is None
