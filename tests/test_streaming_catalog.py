"""Batch = stream over several arriving files; catalog and format round trips."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
import pytest

from skyledger.operators import health as H
from skyledger.operators import traffic as TR
from skyledger.sources import catalog as C
from skyledger.sources import fixtures as fx
from skyledger.streaming.health import health_stream
from skyledger.streaming.rate_limit import rate_limit_stream

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def split_events(tmp_path_factory):
    """The events table cut into four time-ordered files, as if they arrived one by one."""
    d = tmp_path_factory.mktemp("events")
    t = pq.read_table(f"{SF_SMALL}/events.parquet").sort_by("ts")
    n = t.num_rows
    for i in range(4):
        pq.write_table(t.slice(i * n // 4, (i + 1) * n // 4 - i * n // 4), f"{d}/events-{i}.parquet")
    return str(d)


@pytest.fixture(scope="module")
def mixed_events(tmp_path_factory):
    """The events dealt over three files, so every file is late for the one before it; the folder
    has the name of a single-file table."""
    d = tmp_path_factory.mktemp("mixed") / "events.parquet"
    d.mkdir()
    t = pq.read_table(f"{SF_SMALL}/events.parquet").sort_by("ts")
    for i in range(3):
        pq.write_table(t.take(list(range(i, t.num_rows, 3))), f"{d}/part-{i}.parquet")
    return str(d.parent)


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_rate_limit_stream_equals_batch(spark, split_events):
    s = rate_limit_stream(spark, split_events, 1, 86400, max_files_per_trigger=1)
    b = TR.rate_limit_breaches(fx.requests(spark, SF_SMALL), "ip", "ts", 1, 86400)
    assert _rows(s, ["ip", "window_start", "requests"]) == _rows(b, ["ip", "window_start", "requests"])


def test_health_stream_equals_batch(spark, split_events):
    s = health_stream(spark, split_events, max_files_per_trigger=1)
    b = H.health_state(H.probe_outcomes(fx.probes(spark, SF_SMALL)))
    cols = ["probe_id", "success", "counted", "state"]
    assert _rows(s, cols) == _rows(b, cols)


def test_streams_equal_batch_on_files_out_of_order(spark, mixed_events):
    s = rate_limit_stream(spark, mixed_events, 1, 86400, glob="events.parquet", max_files_per_trigger=1)
    b = TR.rate_limit_breaches(fx.requests(spark, SF_SMALL), "ip", "ts", 1, 86400)
    assert _rows(s, ["ip", "window_start", "requests"]) == _rows(b, ["ip", "window_start", "requests"])
    s = health_stream(spark, mixed_events, glob="events.parquet", max_files_per_trigger=1)
    b = H.health_state(H.probe_outcomes(fx.probes(spark, SF_SMALL)))
    cols = ["probe_id", "instance", "ts", "success", "counted", "state"]
    assert _rows(s, cols) == _rows(b, cols)


def test_late_probes_are_reported(spark, mixed_events):
    n = fx.probes(spark, SF_SMALL).count()
    s = health_stream(spark, mixed_events, glob="events.parquet", max_files_per_trigger=1, lateness_s=3600).collect()
    assert len(s) == n and any(r.state == "LATE" for r in s)


def test_repeated_probes_all_come_back(spark, tmp_path):
    t = pq.read_table(f"{SF_SMALL}/events.parquet").sort_by("ts")
    d = tmp_path / "events.parquet"
    d.mkdir()
    half, again = t.num_rows // 2, t.take([5, 5, 900])
    for i, part in enumerate((pa.concat_tables([t.slice(0, half), again]), pa.concat_tables([t.slice(half), again]))):
        pq.write_table(part, f"{d}/part-{i}.parquet")
    cols = ["probe_id", "success", "counted", "state"]
    s = health_stream(spark, str(tmp_path), glob="events.parquet", max_files_per_trigger=1)
    b = H.health_state(H.probe_outcomes(fx.probes(spark, str(tmp_path))))
    assert _rows(s, cols) == _rows(b, cols) and s.count() == t.num_rows + 6
    late = health_stream(spark, str(tmp_path), glob="events.parquet", max_files_per_trigger=1, lateness_s=0)
    assert late.count() == t.num_rows + 6 and late.filter("state = 'LATE'").count() >= 2


def test_registered_streams_read_folders_of_part_files(spark, mixed_events):
    from skyledger.plans import QUERIES
    for name in ("rate_limit_stream", "health_stream"):
        whole, parts = (sorted(QUERIES[name](spark, d).collect()) for d in (SF_SMALL, mixed_events))
        assert whole == parts and whole


def test_compacted_counts(spark, split_events, tmpdir_path):
    from skyledger.streaming import rate_limit as RL
    sink = f"{tmpdir_path}/sink"
    requests = fx.requests_from_events(RL.event_stream(spark, split_events, max_files_per_trigger=1))
    RL.start_rate_limit_stream(requests, sink, f"{tmpdir_path}/ckpt", "ip", 86400).awaitTermination()
    want = sorted(RL.current_breaches(spark, sink, "ip", 1).collect())
    inside = f"{RL.scratch_path(spark, 'streams')}"
    spark.read.parquet(sink).write.partitionBy("batch").parquet(inside)
    assert sorted(RL.current_breaches(spark, RL.compact(spark, inside, 1), "ip", 1).collect()) == want


def test_dataset_load_describe_stats(spark):
    info = {r[0]: r[1] for r in C.create_dataset(spark, "t_ds", "Billing dataset for lab").collect()}
    assert "default_table_ttl_s" in str(info) and "Billing dataset for lab" in str(info)
    df = spark.createDataFrame([(1, ("a", 2.0))], "id int, s struct<x:string,y:double>")
    name = C.load_table(spark, df, "t_ds", "t1")
    assert spark.table(name).count() == 1
    stats = C.table_stats(spark, name).first()
    assert (stats.num_rows, stats.num_bytes) == (1, 8 + 3 + 8) and stats.stored_bytes > 0
    assert ("s.x", "string", True) in C.schema_fields(spark.table(name).schema)
    import json
    doc = json.loads(C.schema_json(spark.table(name)))
    assert [f["name"] for f in doc["fields"]] == ["id", "s"] and doc["fields"][1]["type"]["type"] == "struct"
    assert C.describe_table(spark, name).count() > 0


def test_csv_refuses_structs(spark, tmpdir_path):
    df = spark.createDataFrame([(1, ("a",))], "id int, s struct<x:string>")
    with pytest.raises(ValueError):
        C.write_csv(df, f"{tmpdir_path}/out")


def test_formats_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    for fmt in ("parquet", "orc", "json"):
        df.write.format(fmt).save(f"{tmpdir_path}/{fmt}")
        back = C.read_source(spark, f"{tmpdir_path}/{fmt}", fmt, "id int, v string")
        assert sorted(back.collect()) == sorted(df.collect())


def test_stream_windows_do_not_depend_on_session_zone(spark, split_events):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        s = rate_limit_stream(spark, split_events, 1, 86400, max_files_per_trigger=2)
        b = TR.rate_limit_breaches(fx.requests(spark, SF_SMALL), "ip", "ts", 1, 86400)
        assert _rows(s, ["ip", "window_start", "requests"]) == _rows(b, ["ip", "window_start", "requests"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_load_appends_by_default(spark):
    df = spark.createDataFrame([(1,)], "id int")
    name = C.load_table(spark, df, "t_ds", "t_append", mode="overwrite")
    C.load_table(spark, df, "t_ds", "t_append")
    assert spark.table(name).count() == 2
    C.load_table(spark, df, "t_ds", "t_append", mode="overwrite")
    assert spark.table(name).count() == 1


def test_health_stream_custom_thresholds(spark, split_events):
    s = health_stream(spark, split_events, max_files_per_trigger=1, healthy_threshold=3, unhealthy_threshold=1)
    b = H.health_state(H.probe_outcomes(fx.probes(spark, SF_SMALL)), 3, 1)
    cols = ["probe_id", "state"]
    assert _rows(s, cols) == _rows(b, cols)


def test_read_lines_tail_head(spark, tmpdir_path):
    from skyledger.sources.files import head, read_lines, tail
    with open(f"{tmpdir_path}/driveroutput.000000000", "w") as f:
        f.write("".join(f"line {i}\n" for i in range(1, 121)))
    with open(f"{tmpdir_path}/driveroutput.000000001", "w") as f:
        f.write("Pi is roughly 3.14\n")
    lines = read_lines(spark, tmpdir_path)
    assert lines.count() == 121
    last = tail(lines, 50).where(F.col("path").endswith("000000000")).orderBy("line_no").collect()
    assert len(last) == 50 and last[0].line == "line 71" and last[-1].line == "line 120"
    assert [r.line for r in head(lines, 1).orderBy("path").collect()] == ["line 1", "Pi is roughly 3.14"]


def test_lines_of_a_file_in_many_splits(spark, tmpdir_path):
    from skyledger.sources.files import read_lines
    text = [f"line {i} " + "x" * (i % 40) for i in range(1, 4001)]
    with open(f"{tmpdir_path}/big.log", "w") as f:
        f.write("\n".join(text) + "\n")
    with open(f"{tmpdir_path}/crlf.log", "w", newline="") as f:
        f.write("a\r\n\r\nb")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = read_lines(spark, tmpdir_path).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = {(r.path[-7:], r.line_no): (r.line, r.n_lines) for r in rows}
    assert got == {**{("big.log", i + 1): (t, 4000) for i, t in enumerate(text)},
                   **{("rlf.log", i + 1): (t, 3) for i, t in enumerate(["a\r", "\r", "b"])}}


def test_billing_sees_changed_files(spark, tmpdir_path):
    import shutil
    from skyledger.plans import QUERIES
    from skyledger.plans.loaded import billing_table_name
    sf = f"{tmpdir_path}/sf"
    shutil.copytree(SF_SMALL, sf, copy_function=shutil.copyfile)
    n = QUERIES["billing_total_rows"](spark, sf).first().total_rows
    name = billing_table_name(spark, sf)
    first = C.location(spark, name)
    assert QUERIES["billing_total_rows"](spark, sf).first().total_rows == n
    assert C.location(spark, name) == first  # unchanged files: not loaded again
    t = pq.read_table(f"{sf}/lineitem.parquet")
    import pyarrow as pa
    pq.write_table(pa.concat_tables([t, t]), f"{sf}/lineitem.parquet")
    assert QUERIES["billing_total_rows"](spark, sf).first().total_rows == 2 * n
    assert QUERIES["table_stats"](spark, sf).first().num_rows == 2 * n
    assert C.location(spark, name) != first and billing_table_name(spark, SF_SMALL) != name


def test_results_outlive_a_reload(spark, tmpdir_path):
    import shutil
    from skyledger.plans import QUERIES
    from skyledger.plans.loaded import load_billing
    held = QUERIES["cost_by_service"](spark, SF_SMALL)
    load_billing(spark, SF_SMALL)
    want = held.collect()
    shutil.copytree(SF_SMALL, f"{tmpdir_path}/sf", copy_function=shutil.copyfile)
    QUERIES["billing_total_rows"](spark, f"{tmpdir_path}/sf").collect()  # another folder
    assert held.collect() == want == QUERIES["cost_by_service"](spark, SF_SMALL).collect()


def test_versions_are_pinned_and_removed_by_age(spark):
    import datetime as dt
    import os
    from skyledger.sources import versions as V
    table = "t_versions"
    for i in range(3):
        df = spark.range(i + 1)
        C.load_table(spark, df, "t_ds", table, mode="overwrite", source_tag=f"file-{i}")
        if not i:
            held = spark.table(f"t_ds.{table}")
    listed = V.versions(spark, "t_ds", table).orderBy("version").collect()
    assert [(r.source_tag, r.num_rows, r.replaced_at is None) for r in listed] == [
        ("file-0", 1, False), ("file-1", 2, False), ("file-2", 3, True)]
    assert held.count() == 1 and V.read_version(spark, "t_ds", table).count() == 3
    old = V.read_version(spark, "t_ds", table, listed[1].version)
    assert old.count() == 2 and V.remove_old(spark, "t_ds", table, 3600) == []
    late = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=2)
    assert V.remove_old(spark, "t_ds", table, 3600, late) == [r.version for r in listed[:2]]
    assert not os.path.exists(listed[0].path.replace("file:", ""))
    assert [r.version for r in V.versions(spark, "t_ds", table).collect()] == [listed[2].version]
    assert spark.table(f"t_ds.{table}").count() == 3
    with pytest.raises(ValueError):
        V.read_version(spark, "t_ds", table, listed[0].version)
    with pytest.raises(ValueError):
        V.read_version(spark, "t_ds", "never_loaded")


def test_dataset_tables_expire(spark):
    C.create_dataset(spark, "t_ttl", default_ttl_s=3600)
    C.load_table(spark, spark.createDataFrame([(1,)], "id int"), "t_ttl", "t1", mode="overwrite")
    assert [r.expired for r in C.expired_tables(spark, "t_ttl", "2000-01-01 00:00:00").collect()] == [False]
    assert [r.expired for r in C.expired_tables(spark, "t_ttl", "2999-01-01 00:00:00").collect()] == [True]
