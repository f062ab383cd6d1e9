"""Full copies, one-level listings, globs, dependency order and hot-key joins."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skyledger.operators import network as NW
from skyledger.operators import objects as O
from skyledger.plans.check import compare, duckdb_connection


def test_queries_equal_their_oracle(spark):
    con = duckdb_connection("/root/testdata/sf0.01")
    for name in ("snapshot_versions_4h", "snapshot_full_4h", "list_level", "glob_list", "prefix_tree", "reconcile_order",
                 "internal_pairs", "object_versions", "prefix_list"):
        r = compare(spark, name, "/root/testdata/sf0.01", con)
        assert r["status"] == "ok", r


def test_every_copy_is_the_state_at_its_time(spark, tmpdir_path):
    rng, start = random.Random(1), dt.datetime(2024, 1, 1)
    rows = [(rng.choice([1, 2, 3, None]), start + dt.timedelta(minutes=rng.randrange(0, 6000)), rng.choice([1, 1, 2, None])) for _ in range(120)]
    df = spark.createDataFrame([*rows, (9, None, 5)], "k long, ts timestamp_ntz, v int")
    versions = O.snapshot_versions(df, "k", "ts", "4 hours", ("v",))
    stored = versions.collect()
    until = start + dt.timedelta(hours=112)
    got = {(r.snapshot_time, r.k): r.v for r in O.full_snapshots(versions, str(until), "4 hours").collect()}
    want, t = {}, start + dt.timedelta(hours=4)
    while t <= until:
        for k in (1, 2, 3, None):
            past = [r for r in rows if r[0] == k and r[1] < t]
            if past:
                want[t, k] = max(past, key=lambda r: (r[1], r[2] is not None, r[2] or 0))[2]
        t += dt.timedelta(hours=4)
    assert got == want and len(stored) < len(want)
    by_key = {}
    for r in sorted(stored, key=lambda r: (str(r.k), r.valid_from)):
        assert r.k not in by_key or by_key[r.k].v != r.v  # unchanged rows are stored once
        by_key[r.k] = r
    at = start + dt.timedelta(hours=48)
    assert {r.k: r.v for r in O.snapshot_at(versions, str(at)).collect()} == {k: v for (t, k), v in want.items() if t == at}
    totals = O.snapshot_totals(versions, F.coalesce("v", F.lit(0)), "4 hours").collect()
    for r in totals:
        here = [v or 0 for (t, _), v in want.items() if t == r.snapshot_time]
        assert (r.keys, r.total) == (len(here), sum(here))
    root = O.write_full_snapshots(versions, f"{tmpdir_path}/copies", str(until), "4 hours")
    assert spark.read.parquet(root).count() == len(want)


@pytest.mark.parametrize(("pattern", "want"), [
    ("a/*", ["a/x"]), ("a/**", ["a/x", "a/y/z", "a/y/w/z"]), ("**/z", ["a/y/z", "a/y/w/z", "z"]), ("a/?", ["a/x"]),
    ("a/", ["a/x", "a/y/z", "a/y/w/z"]), ("*", ["z", "b.c"]), ("b.?", ["b.c"]), ("a/*/z", ["a/y/z"]), ("b*c", ["b.c"]), ("q*", [])])
def test_globs(spark, pattern, want):
    df = spark.createDataFrame([(n,) for n in ("a/x", "a/y/z", "a/y/w/z", "z", "b.c")] + [(None,)], "name string")
    assert sorted(r.name for r in O.list_prefix(df, pattern).collect()) == sorted(want)


def test_levels_of_a_listing(spark):
    rows = [("a/x", 1), ("a/y/z", 2), ("a/y/w/z", 3), ("top", 4), ("a/", 5), ("/lead", 6), (None, 7)]
    df = spark.createDataFrame(rows, "name string, size_bytes long")

    def level(p):
        return sorted(tuple(r) for r in O.list_level(df, p).collect())

    assert level("") == [("/", "prefix", 1, 6), ("a/", "prefix", 4, 11), ("top", "object", 1, 4)]
    assert level("a/") == [("a/", "object", 1, 5), ("a/x", "object", 1, 1), ("a/y/", "prefix", 2, 5)]
    tree = sorted(tuple(r) for r in O.prefix_tree(df).collect())
    assert tree == [("", 0, 6, 21, 1), ("/", 1, 1, 6, 1), ("a/", 1, 4, 11, 2), ("a/y/", 2, 2, 5, 1), ("a/y/w/", 3, 1, 3, 1)]


def plain_levels(edges):
    needs = {}
    for a, b in edges:
        needs.setdefault(a, set()).add(b)
        needs.setdefault(b, set())
    out, changed = {}, True
    while changed:
        changed = False
        for n, of in needs.items():
            if n not in out and all(b in out for b in of):
                out[n], changed = max((out[b] + 1 for b in of), default=0), True
    return {n: out.get(n) for n in needs}


def test_dependency_levels_of_random_graphs(spark):
    rng = random.Random(4)
    edges = [(f"n{i}", f"n{rng.randrange(max(0, i - 12), i)}") for i in range(1, 120) for _ in range(2)]
    edges += [(f"leaf{i}", "n0") for i in range(200)] + [("c1", "c2"), ("c2", "c3"), ("c3", "c1"), ("behind", "c1"), ("self", "self")]
    df = spark.createDataFrame([*edges, edges[0], (None, "n0"), ("alone", None)], "name string, needs string")
    got = {r.name: r.level for r in O.dependency_levels(df).collect()}
    assert got == plain_levels(edges) and got["behind"] is None and got["self"] is None
    with pytest.raises(ValueError):
        O.dependency_levels(df, max_rounds=2)
    plan = spark.createDataFrame([("n0", "recreate"), ("n5", "create"), ("leaf1", "delete"), ("c1", "create"), ("alone", "create"), ("n7", "skip")],
                                 "name string, action string")
    steps = {(r.name, r.operation): (r.phase, r.step) for r in O.ordered_plan(plan, df).collect()}
    top = max(v for v in got.values() if v is not None)
    assert steps == {("n0", "delete"): (1, top), ("n0", "create"): (2, 0), ("n5", "create"): (2, got["n5"]), ("leaf1", "delete"): (1, top - 1),
                     ("c1", "create"): (2, None), ("alone", "create"): (2, 0)}


def test_hot_keys_are_split_and_nothing_else_changes(spark):
    big = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else concat('k', id % 400) end AS k")
    small = spark.createDataFrame([("hot", 1), ("k5", 2), ("k7", 3), ("unused", 4)], "k string, v int")
    heavy = NW.heavy_keys(big, "k", 0.05)
    assert heavy == {"hot": 7}  # a third is 6.7 shares of a twentieth
    got = NW.salted_left_join(big, small, "k", 0.05)
    assert sorted(got.collect(), key=str) == sorted(big.join(small, "k", "left").collect(), key=str)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan
    assert NW.salted_left_join(big.limit(0), small, "k").collect() == []


def test_an_unknown_name_is_one_name(spark):
    df = [spark.createDataFrame(r, "name string, size_bytes long") for r in ([("a", 1), (None, 2)], [(None, 3), ("b", 4)])]
    assert sorted((tuple(r) for r in O.sync_plan(*df).collect()), key=str) == sorted(
        [("a", 1, None, "new"), (None, 2, 3, "changed"), ("b", None, 4, "kept")], key=str)
    assert sorted((r.name or "", r.origin) for r in O.sync_apply(*df).collect()) == [("", "src"), ("a", "src"), ("b", "dst")]


def test_windows_without_requests_have_the_minimum(spark):
    from skyledger.operators import traffic as TR
    at = dt.datetime(2024, 1, 1)
    rows = [("n", at)] * 30 + [("n", at + dt.timedelta(minutes=3)), (None, at), ("m", at + dt.timedelta(minutes=9)), ("n", None)]
    load = spark.createDataFrame(rows, "g string, ts timestamp_ntz")
    got = sorted((tuple(r) for r in TR.replica_timeline(load, "g", "ts", 60, 0.2, 1.0, 1.0, 1, 2).collect()), key=str)
    minute = [at + dt.timedelta(minutes=i) for i in range(10)]
    assert got == sorted([("n", minute[0], 30, 3, 2), ("n", minute[1], 0, 0, 1), ("n", minute[2], 0, 0, 1), ("n", minute[3], 1, 1, 1),
                          (None, minute[0], 1, 1, 1), ("m", minute[9], 1, 1, 1)], key=str)


def test_queries_of_traffic_and_sync_equal_their_oracle(spark):
    con = duckdb_connection("/root/testdata/sf0.01")
    for name in ("replica_timeline", "replica_recommendation", "sync_plan", "sync_apply"):
        r = compare(spark, name, "/root/testdata/sf0.01", con)
        assert r["status"] == "ok", r
