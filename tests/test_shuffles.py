"""What is shuffled: line items twice for the billing export, connections once a join, hot ends in one pass."""

import re

import pytest

from skyledger.operators import network as NW
from skyledger.plans.registry import QUERIES
from skyledger.sources import fixtures as fx

from conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_small_tables(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_billing_shuffles_line_items_twice(spark, no_small_tables):
    dealt = re.findall(r"Exchange hashpartitioning\((\w+?)#", plan_of(fx.billing(spark, SF_SMALL)))
    assert sorted(dealt) == ["c_custkey", "l_orderkey", "l_partkey", "o_custkey", "o_orderkey", "p_partkey"]


def test_shuffles_are_the_same_at_every_size(spark):
    for df, joins in ((fx.billing(spark, SF_SMALL), 3), (QUERIES["internal_pairs"](spark, SF_SMALL), 3)):
        assert len(re.findall(r"\bSortMergeJoin\b", plan_of(df))) == joins


def test_billing_of_odd_keys_is_the_plain_join(spark, tmpdir_path):
    li = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date")
    line = lambda *k: (*k, 1, 2.0, 100.5, 0.05, 0.08, "A", "F", None)
    tables = {"lineitem": ([line(1, 1, 1), line(1, 1, 1), line(2, 2, 2), line(None, 1, 1), line(3, 1, 1), line(1, None, 1), line(1, 1, 9),
                            (2, 1, 1, 2, None, None, 0.1, None, None, "O", None)], li),
              "orders": ([(1, 1), (2, 2), (2, 2), (3, None), (None, 1)], "o_orderkey bigint, o_custkey bigint"),
              "part": ([(1, "p", "t"), (2, "q", None), (2, "r", "u"), (None, "n", "n")], "p_partkey bigint, p_name string, p_type string"),
              "supplier": ([(1, 1), (2, 2), (2, 1), (None, 1)], "s_suppkey bigint, s_nationkey int"),
              "customer": ([(1, "a", 1), (2, "b", 2), (2, "c", None), (None, "n", 1)], "c_custkey bigint, c_name string, c_nationkey int"),
              "nation": ([(1, "X"), (2, "Y"), (None, "Z")], "n_nationkey int, n_name string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmpdir_path}/{name}.parquet")
        spark.read.parquet(f"{tmpdir_path}/{name}.parquet").createOrReplaceTempView(f"odd_{name}")
    want = spark.sql("""
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, c_custkey, c_name, p_name, p_type, n_name, cast(round(cast(l_extendedprice AS decimal(12,2))
               * cast(l_discount AS decimal(4,2)) * cast(l_tax AS decimal(4,2)) * 0.05BD, 2) AS decimal(18,2)) AS cost
        FROM odd_lineitem, odd_orders, odd_part, odd_supplier, odd_customer, odd_nation WHERE l_orderkey = o_orderkey
         AND l_partkey = p_partkey AND l_suppkey = s_suppkey AND o_custkey = c_custkey AND s_nationkey = n_nationkey""").collect()
    for name in tables:
        spark.catalog.dropTempView(f"odd_{name}")
    got = fx.billing(spark, tmpdir_path).selectExpr(
        "line_item.order_key", "line_item.part_key", "line_item.supp_key", "line_item.line_number", "cast(substring(project.id, 6) AS bigint)",
        "project.name", "sku.description", "service.description AS s", "location.country", "cost").collect()
    assert len(want) > 8 and sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)


def test_hot_ends_are_found_in_one_pass(spark, monkeypatch):
    conns = spark.range(900).selectExpr("id", "if(id % 3 = 0, 'a', concat('s', id)) AS src", "if(id % 2 = 0, 'b', if(id % 5 = 1, null, concat('d', id))) AS dst")
    found = NW.heavy_keys_of(conns, ["src", "dst"], 0.1)
    assert found == {"src": NW.heavy_keys(conns, "src", 0.1), "dst": NW.heavy_keys(conns, "dst", 0.1)} and set(found["dst"]) == {"b"}
    passes, plain = [], NW.heavy_keys_of
    monkeypatch.setattr(NW, "heavy_keys_of", lambda *a: passes.append(1) or plain(*a))
    places = spark.createDataFrame([("a", "n"), ("b", "n"), ("b", "m"), ("s1", "n"), ("d3", "m")], "name string, network string")
    got = NW.reachability(conns, places)
    s, d = (places.selectExpr(f"name AS {e}", f"network AS {e}_network") for e in ("src", "dst"))
    want = conns.join(s, "src", "left").join(d, "dst", "left")
    columns = ["id", "src", "dst", "src_network", "dst_network"]
    assert sorted(got.select(columns).collect(), key=str) == sorted(want.select(columns).collect(), key=str) and len(passes) == 1
