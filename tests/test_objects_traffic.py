"""Object inventories, lifecycle, sync, snapshots, rate limits, health, re-key, text."""

import datetime as dt
import os

from pyspark.sql import functions as F

from skyledger.functions import text as X
from skyledger.operators import health as H
from skyledger.operators import objects as O
from skyledger.operators import rekey as R
from skyledger.operators import traffic as TR
from skyledger.operators.compute import pi_job

OBJ = "name string, generation long, created timestamp_ntz, size_bytes long"
D = dt.datetime


def test_single_version_object(spark):
    df = spark.createDataFrame([("solo", 5, D(2020, 1, 1), 10)], OBJ)
    assert O.list_versions(df).first().version_no == 1
    r = O.oldest_vs_current(df).first()
    assert (r.versions, r.oldest_generation, r.current_generation, r.size_change) == (1, 5, 5, 0)


def test_ttl_keep_plus_drop_is_input(spark):
    df = spark.createDataFrame([("a", 1, D(2020, 1, 1), 1), ("b", 2, D(2020, 1, 2, 12), 1)], OBJ)
    out = O.expire_by_ttl(df, "created", 86400, "2020-01-02 06:00:00")
    got = {r.name: r.expired for r in out.collect()}
    assert got == {"a": True, "b": False}


def test_lifecycle_boundary_31_days(spark):
    df = spark.createDataFrame([("old", 1, D(2020, 1, 1), 1), ("new", 2, D(2020, 1, 2), 1)], OBJ)
    got = {r.name: r.action for r in O.lifecycle_delete(df, "created", "2020-02-01").collect()}
    assert got == {"old": "Delete", "new": "Keep"}


def test_sync_apply_is_idempotent_and_never_deletes(spark):
    src = spark.createDataFrame([("x", 1), ("y", 2)], "name string, size_bytes long")
    dst = spark.createDataFrame([("y", 3), ("z", 4)], "name string, size_bytes long")
    plan = {r.name: r.status for r in O.sync_plan(src, dst).collect()}
    assert plan == {"x": "new", "y": "changed", "z": "kept"}
    once = O.sync_apply(src, dst).select("name", "size_bytes")
    twice = O.sync_apply(src, once).select("name", "size_bytes")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.name for r in once.collect()} == {"x", "y", "z"}


def test_glob_and_prefix(spark):
    df = spark.createDataFrame([("setup.html", 1, D(2020, 1, 1), 1), ("setup2.html", 1, D(2020, 1, 1), 1),
                                ("x_setup", 1, D(2020, 1, 1), 1)], OBJ)
    assert O.list_prefix(df, "setup*").count() == 2
    assert O.list_prefix(df, "x_").count() == 1


def test_list_files_and_snapshot(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/firstlevel/secondlevel")
    for p in ("firstlevel/setup.html", "firstlevel/secondlevel/setup.html", "firstlevel/other.txt"):
        with open(f"{tmpdir_path}/{p}", "w") as f:
            f.write("<html></html>\n")
    assert O.list_files(spark, f"{tmpdir_path}/firstlevel").count() == 3
    assert O.list_files(spark, f"{tmpdir_path}/firstlevel", "setup*").count() == 2
    df = spark.createDataFrame([(1,)], "a int")
    path = O.write_snapshot(df, f"{tmpdir_path}/snap", "20200101-000000")
    assert path.endswith("20200101-000000-world")
    try:
        O.write_snapshot(df, f"{tmpdir_path}/snap", "20200101-000000")
        raise AssertionError("overwrote a snapshot")
    except Exception as e:
        assert "already exists" in str(e).lower() or "PATH_ALREADY_EXISTS" in str(e)


def test_reconcile_modes(spark):
    want = spark.createDataFrame([("a",), ("b",)], "name string")
    have = spark.createDataFrame([("b",), ("c",)], "name string")
    assert {(r.name, r.action) for r in O.reconcile(want, have).collect()} == {("a", "create"), ("b", "skip")}
    assert {(r.name, r.action) for r in O.reconcile(want, have, mode="recreate").collect()} == {
        ("a", "create"), ("b", "recreate")}


REQ = "request_id long, ip string, ts timestamp_ntz"


def test_breaches_agree_with_denials(spark):
    rows = [(i, "1.1.1.1", D(2020, 1, 1, 0, 0, i)) for i in range(5)] + \
           [(10 + i, "2.2.2.2", D(2020, 1, 1, 0, 0, i)) for i in range(2)]
    df = spark.createDataFrame(rows, REQ)
    br = TR.rate_limit_breaches(df, limit=3, interval_s=60)
    assert [(r.ip, r.requests) for r in br.collect()] == [("1.1.1.1", 5)]
    v = TR.rate_limit_verdicts(df, limit=3, interval_s=60)
    denied = {r.request_id for r in v.where("verdict <> 'allow'").collect()}
    assert denied == {3, 4}


def test_replica_bounds(spark):
    rows = [(i, "n", D(2020, 1, 1, 0, 0, 0)) for i in range(100)]
    df = spark.createDataFrame(rows, "request_id long, g string, ts timestamp_ntz")
    r = TR.replica_recommendation(df, "g", "ts", 60, max_rate_per_instance=1.0).first()
    assert r.needed == 3 and r.recommended == 2   # 100 / (60 * 0.8) -> 3, clamped to 2


def test_cache_key_policy(spark):
    df = spark.createDataFrame([("https://h.example.com/a/b?x=1#frag",)], "url string")
    full = df.select(TR.cache_key(F.col("url")).alias("k")).first().k
    bare = df.select(TR.cache_key(F.col("url"), False, False, False).alias("k")).first().k
    assert (full, bare) == ("https://h.example.com/a/b?x=1", "/a/b")


def test_sample_rate_one_keeps_all(spark):
    df = spark.range(100).withColumnRenamed("id", "request_id")
    assert TR.sample_logs(df, "request_id", 1.0).count() == 100
    assert 0 < TR.sample_logs(df, "request_id", 0.5).count() < 100


PROBE = "probe_id long, instance long, ts timestamp_ntz, ok boolean, latency_s double"


def test_health_one_probe_and_alternating(spark):
    t = lambda s: D(2020, 1, 1) + dt.timedelta(seconds=s)
    rows = [(1, 1, t(0), True, 0.1)]                                       # only probe: in the delay
    rows += [(10 + i, 2, t(100 + 5 * i), i % 2 == 0, 0.1) for i in range(20)]  # alternating
    rows += [(40, 3, t(0), True, 0.1), (41, 3, t(70), False, 0.1), (42, 3, t(75), True, 9.0),  # timeout
             (43, 3, t(80), True, 0.1), (44, 3, t(85), True, 0.1)]
    out = H.health_state(H.probe_outcomes(spark.createDataFrame(rows, PROBE)))
    st = {r.probe_id: r.state for r in out.collect()}
    assert st[1] == "UNKNOWN"
    assert {st[10 + i] for i in range(20)} == {"UNKNOWN"}
    assert (st[41], st[42], st[43], st[44]) == ("UNKNOWN", "UNHEALTHY", "UNHEALTHY", "HEALTHY")


def test_rekey_roundtrip(spark):
    df = spark.createDataFrame([(1, "alpha"), (2, "beta")], "doc_id long, text string")
    old, new = R.key_bytes("o"), R.key_bytes("n")
    enc = R.encrypt(df, "text", old)
    rot = R.rewrite(enc, "payload", old, new, F.col("doc_id") == 1)
    got = {r.doc_id: r.recovered for r in R.read_with(rot, "payload", new).collect()}
    assert got == {1: "alpha", 2: None}


def test_line_functions_short_documents(spark):
    df = spark.createDataFrame([("a\nb\nc",), ("",), ("x",)], "t string")
    r = df.select(X.drop_last_lines(F.col("t"), 5).alias("d"), X.first_line(F.col("t")).alias("f"),
                  X.last_lines(F.col("t"), 2).alias("l")).collect()
    assert [(x.d, x.f, x.l) for x in r] == [("", "a", "b\nc"), ("", "", ""), ("", "x", "x")]


def test_scalar_functions(spark):
    df = spark.createDataFrame([("us-east1-b", "  a  b c ", "", D(2024, 1, 2, 3, 4, 5))],
                               "z string, s string, e string, ts timestamp_ntz")
    r = df.select(X.zone_to_region(F.col("z")).alias("r"), X.nth_word(F.col("s"), 2).alias("w"),
                  X.nth_word(F.col("s"), 9).alias("w9"), X.default_if_empty(F.col("e"), "d").alias("d"),
                  X.timestamp_key(F.col("ts")).alias("k"), X.base64_key(F.lit(1)).alias("b")).first()
    assert (r.r, r.w, r.w9, r.d, r.k) == ("us-east1", "b", "", "d", "20240102-030405")
    assert len(r.b) == 44


def test_pi_job(spark):
    r = pi_job(spark, tasks=4, points_per_task=20000).first()
    assert abs(r.pi_estimate - 3.14159) < 0.05


def test_backend_document_defaults():
    b = TR.backend_settings()
    assert b["cache_key"] == {"include_protocol": True, "include_host": True, "include_query": True}
    assert (b["sample_rate"], b["max_rate_per_instance"], b["capacity_scaler"]) == (1.0, 50.0, 1.0)


def test_snapshot_backfill_one_folder_per_window(spark, tmpdir_path):
    t = lambda h, m: D(2024, 1, 1, h, m)
    ev = spark.createDataFrame([(1, t(0, 10), 1.0), (1, t(3, 50), 2.0), (1, t(4, 5), 3.0), (2, t(9, 0), 4.0)],
                               "user_id long, ts timestamp_ntz, value double")
    root = O.write_snapshot_windows(ev, f"{tmpdir_path}/world", "user_id", "ts", "4 hours", ("value",))
    back = spark.read.parquet(root)
    got = {(r.user_id, r.snapshot_key): r.last_value for r in back.collect()}
    assert got == {(1, "20240101-040000-world"): 2.0, (1, "20240101-080000-world"): 3.0,
                   (2, "20240101-120000-world"): 4.0}


def test_sync_plan_with_unknown_sizes(spark):
    cols = "name string, size_bytes long"
    src = spark.createDataFrame([("a", None), ("b", 5), ("c", None), ("d", 4), ("e", 1)], cols)
    dst = spark.createDataFrame([("a", 3), ("b", None), ("c", None), ("d", 4), ("z", None)], cols)
    got = {r.name: r.status for r in O.sync_plan(src, dst).collect()}
    assert got == {"a": "changed", "b": "changed", "c": "same", "d": "same", "e": "new", "z": "kept"}
    src, dst = (df.withColumn("md5", F.lit(v)) for df, v in ((src, "x"), (dst, "y")))
    assert {r.name: r.status for r in O.sync_plan(src, dst, also=("md5",)).collect()}["d"] == "changed"


def test_verdicts_over_a_clock_change(spark):
    rows = [(1, "k", "2024-03-10 02:30:00"), (2, "k", "2024-03-10 03:05:00"), (3, "k", "2024-03-10 01:59:00")]
    df = spark.createDataFrame(rows, "request_id int, ip string, t string").select(
        "request_id", "ip", F.col("t").cast("timestamp_ntz").alias("ts"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            from skyledger.operators import scan
            for hot in (2, 8192):
                scan.HOT_ROWS, keep = hot, scan.HOT_ROWS
                got = {r.request_id: r.position for r in TR.rate_limit_verdicts(df, limit=1, interval_s=86400).collect()}
                scan.HOT_ROWS = keep
                assert got == {3: 1, 1: 2, 2: 3}, (zone, hot)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_edits_keep_carriage_returns(spark):
    from skyledger.functions import text as X
    df = spark.createDataFrame([("License.\r",), ("License.",), ('token = "a"\rb',)], "line string")
    got = [tuple(r) for r in df.select(X.replace_at_end(F.col("line"), ".", "!"),
                                       X.replace_rest(F.col("line"), "token = ", "X")).collect()]
    assert got == [("License.\r", "License.\r"), ("License!", "License."), ('token = "a"\rb', "X")]


def test_repeated_metadata_key(spark):
    from skyledger.operators import nested as N
    df = spark.createDataFrame([([("a", "1"), ("a", "2"), ("b", None)],), ([],)], "items array<struct<key:string,value:string>>")
    got = [tuple(r) for r in df.select(*[N.lookup(F.col("items"), k) for k in ("a", "b", "c")]).collect()]
    assert got == [("1", None, None), (None, None, None)]


def test_policy_verdicts_limit_only_throttled_requests(spark):
    import json
    rule = lambda action, priority, ranges, **more: {
        "action": action, "priority": priority, "match": {"config": {"srcIpRanges": ranges}}, **more}
    doc = json.dumps({"rules": [
        rule("allow", 1, ["10.0.0.0/8"]), rule("deny(404)", 2, ["11.0.0.0/8"]),
        rule("throttle", 3, ["*"], rateLimitOptions={"exceedAction": "deny(429)", "conformAction": "allow",
             "enforceOnKey": "IP", "rateLimitThreshold": {"count": 1, "intervalSec": 60}})]})
    rows = [(i, ip, "2024-01-01 00:00:0%d" % i) for i, ip in enumerate(["10.0.0.1", "10.0.0.1", "11.0.0.1", "9.9.9.9", "9.9.9.9"])]
    df = spark.createDataFrame(rows, "request_id int, ip string, t string").select(
        "request_id", "ip", F.col("t").cast("timestamp_ntz").alias("ts"))
    got = {r.request_id: r.verdict for r in TR.policy_verdicts(df, doc).collect()}
    assert got == {0: "allow", 1: "allow", 2: "deny(404)", 3: "allow", 4: "deny(429)"}
