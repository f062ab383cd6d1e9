"""Ordered keyed state: timelines against a plain decision, streams against the batch operator."""

import datetime as dt
import random

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from skyledger.operators import health as H
from skyledger.plans.traffic import HEALTH_SQL
from skyledger.sources import fixtures as fx
from skyledger.streaming import health as S

START = dt.datetime(2024, 1, 1)


def plain(probes, delay, up, down):
    """(id, us) -> (counted, state) one probe after the other."""
    out, run, last, state = [], 0, None, "UNKNOWN"
    first = min(p[1] for p in probes)
    for i, us, ok in sorted(probes, key=lambda p: (p[1], p[0])):
        if us < first + delay * 1_000_000:
            out.append((i, us, ok, False, "UNKNOWN"))
            continue
        run = run + 1 if ok == last else 1
        last = ok
        if run >= (up if ok else down):
            state = "HEALTHY" if ok else "UNHEALTHY"
        out.append((i, us, ok, True, state))
    return sorted(out)


def run(batches, **settings):
    """Feed batches; the latest version of every probe, all rows that were returned, and the chunks."""
    chunks, index, latest, rows = {}, None, {}, 0
    for batch in batches:
        t = S.Timeline(index, lambda k: chunks[k], chunks.__setitem__, lambda k: chunks.pop(k, None), **settings)
        found = t.add(*(np.array(c, k) for c, k in zip(zip(*batch), (np.int64, np.int64, bool))))
        index = t.index()
        assert sorted(chunks) == index[7] and all(a <= b for a, b in zip(index[7], index[8]))
        fresh = {}
        for i, us, ok, counted, state in zip(*(c.tolist() for c in found)) if found else []:
            fresh.setdefault((i, us), []).append((i, us, ok, counted, state))
            rows += 1
        latest.update(fresh)
    return sorted(r for same in latest.values() for r in same), rows, chunks


@pytest.mark.parametrize("seed", range(12))
def test_any_order_of_arrival_gives_the_plain_states(seed):
    rng = random.Random(seed)
    probes = [(i, rng.randrange(0, 400) * 1_000_000, rng.random() < rng.choice([0.1, 0.5, 0.95])) for i in range(300)]
    probes += probes[:9]  # repeated probes
    if seed % 2:
        rng.shuffle(probes)
    delay, up, down, size = rng.choice([0, 60]), rng.randint(1, 3), rng.randint(1, 3), rng.choice([4, 16, 512])
    cuts = sorted(rng.sample(range(1, len(probes)), 9))
    batches = [probes[a:b] for a, b in zip([0, *cuts], [*cuts, len(probes)])]
    latest, _, chunks = run(batches, initial_delay_s=delay, up=up, down=down, chunk_probes=size)
    assert latest == plain(probes, delay, up, down)
    assert all(len(c[0]) <= 2 * size or len(set(c[1])) == 1 for c in chunks.values())


def test_a_late_probe_changes_only_what_it_must():
    probes = [(i, i * 1_000_000, True) for i in range(5000)]
    late = (9000, 2_500_500_000, True)
    latest, rows, _ = run([probes[:4000], probes[4000:], [late]], initial_delay_s=0, chunk_probes=100)
    assert latest == plain([*probes, late], 0, 2, 2) and rows == 5001
    broken = [(9000, 2_500_400_000, False), (9001, 2_500_500_000, False)]
    latest, rows, _ = run([probes, broken], initial_delay_s=0, chunk_probes=100)
    assert latest == plain([*probes, *broken], 0, 2, 2) and rows == 5003  # one probe behind them changes


def test_decided_probes_leave_the_state():
    probes = [(i, i * 1_000_000, i % 7 != 0) for i in range(1000)]
    latest, _, chunks = run([probes[i:i + 50] for i in range(0, 1000, 50)], initial_delay_s=0, lateness_s=30, chunk_probes=16)
    assert latest == plain(probes, 0, 2, 2) and sum(len(c[0]) for c in chunks.values()) == 30
    latest, _, _ = run([probes, [(2000, 5_500_000, True)]], initial_delay_s=0, lateness_s=30)
    assert (2000, 5_500_000, True, False, "LATE") in latest


def events_table(rows):
    kinds = {"event_id": pa.int64(), "user_id": pa.int64(), "ts": pa.timestamp("us"), "event_type": pa.string(), "value": pa.float64()}
    return pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(kinds.items())})


def odd_events():
    """Two instances with missing answers, latencies and times."""
    rng, rows = random.Random(5), []
    for i in range(400):
        ts = START + dt.timedelta(seconds=rng.randrange(0, 3000))
        rows.append((i, i % 2, ts if rng.random() < 0.97 else None, rng.choice(["error", "view", "view", None]),
                     rng.choice([10.0, 20.0, 900.0, None])))
    return rows


COLS = ["probe_id", "instance", "ts", "success", "counted", "state"]


def rows_of(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=str)


def test_missing_outcomes_are_failures_in_batch_stream_and_oracle(spark, tmp_path):
    rows = odd_events()
    folder = tmp_path / "events.parquet"
    folder.mkdir()
    for i in range(5):
        pq.write_table(events_table(rows[i::5]), folder / f"part-{i}.parquet")
    batch = rows_of(H.health_state(H.probe_outcomes(fx.probes(spark, str(tmp_path)))))
    stream = rows_of(S.health_stream(spark, str(tmp_path), glob="events.parquet", max_files_per_trigger=1, chunk_probes=8))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/*.parquet')")
    sql = "WITH probes AS (" + __import__("skyledger.plans.oracle_fixtures", fromlist=["F"]).FIXTURES["probes"][0] + ")," \
        + HEALTH_SQL.strip()[5:]
    oracle = con.sql(sql)
    place = [oracle.columns.index(c) for c in COLS]
    want = sorted((tuple(r[i] for i in place) for r in oracle.fetchall()), key=str)
    assert batch == want and stream == want and len(want) == 400
    assert {r[5] for r in want} == {"UNKNOWN", "HEALTHY", "UNHEALTHY"}


def test_null_outcome_in_the_middle_of_a_run(spark):
    answers = [True, True, True, None, False, None, False]
    df = spark.createDataFrame([(i, 1, START + dt.timedelta(seconds=i), a, True) for i, a in enumerate(answers)],
                               "probe_id long, instance long, ts timestamp_ntz, success boolean, counted boolean")
    got = [r.state for r in H.health_state(df, 2, 2).orderBy("probe_id").collect()]
    assert got == ["UNKNOWN", "HEALTHY", "HEALTHY", "HEALTHY", "UNHEALTHY", "UNHEALTHY", "UNHEALTHY"]


def test_a_hot_instance_writes_about_one_row_a_probe(spark, tmp_path):
    folder = tmp_path / "events.parquet"
    folder.mkdir()
    rows = [(i, 1, START + dt.timedelta(seconds=i), "error" if i % 11 == 0 else "view", 10.0) for i in range(1000)]
    for k in range(10):
        late = [rows[100 * k - 40]] if k else []  # and one probe of the file before comes again
        pq.write_table(events_table(rows[100 * k:100 * k + 100] + late), folder / f"part-{k}.parquet")
    log = S.health_log(spark, str(tmp_path), glob="events.parquet", max_files_per_trigger=1, chunk_probes=32)
    assert log.count() <= 1000 + 9 * 3
    assert S.latest_states(log).count() == 1009


def test_a_silent_instance_leaves_the_store(spark, tmp_path):
    import time
    folder, root = tmp_path / "events.parquet", S.scratch_path(spark, "streams", "expiry")
    folder.mkdir()

    def step(k, second, instance):
        rows = [(10 * k + i, instance, START + dt.timedelta(seconds=second + i), "view", 10.0) for i in range(3)]
        pq.write_table(events_table(rows), folder / f"part-{k}.parquet")
        probes = S.probes_from_events(S.event_stream(spark, str(tmp_path), "events.parquet", None))
        q = S.start_health_stream(probes, f"{root}/sink", f"{root}/checkpoint", initial_delay_s=0, expire_after_s=4)
        q.awaitTermination()
        return {r.probe_id: r.state for r in spark.read.parquet(f"{root}/sink").filter("version > 0").collect()}

    assert step(0, 0, 1)[2] == "HEALTHY"
    assert step(1, 100, 1)[10] == "HEALTHY"  # the run goes on
    time.sleep(6)
    step(2, 200, 2)  # another instance; the timer of the first one fires
    assert step(3, 300, 1)[30] == "UNKNOWN"  # its state is gone
