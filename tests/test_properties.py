"""Randomised checks against brute force on small frames."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from skyledger.operators import access as A
from skyledger.operators import health as H
from skyledger.operators import scan
from skyledger.operators.scan import running
from skyledger.sources import literals

ROLES = ["roles/viewer", "roles/storage.objectViewer", "roles/storage.objectCreator"]
PERMS = ["storage.objects.get", "storage.objects.list", "storage.objects.create", "compute.instances.list",
         "iam.serviceAccounts.actAs"]


def brute_access(log, attempts):
    grants = {}
    for r, p in literals.ROLE_PERMISSIONS:
        grants.setdefault(p, set()).add(r)
    out = {}
    for seq, member, res, perm in attempts:
        resets = [s for s, m, r, _, a in log if r == res and a == "reset" and s < seq]
        reset = max(resets) if resets else None
        ok = False
        for role in grants.get(perm, ()):
            acts = [(s, a) for s, m, r, ro, a in log
                    if m == member and r == res and ro == role and a in ("add", "remove") and s < seq]
            if acts:
                s, a = max(acts)
                ok |= a == "add" and (reset is None or s > reset)
        out[seq] = ok
    return out


def test_access_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(scan, "HOT_ROWS", 8)  # most keys are split
    for seed in range(4):
        rnd = random.Random(seed)
        log = [(rnd.randint(0, 80), rnd.randint(1, 2), f"b{rnd.randint(0, 1)}", rnd.choice(ROLES),
                rnd.choice(["add", "add", "remove", "reset"])) for _ in range(70)]
        log = list({s: row for s, *_ in log for row in [next(r for r in log if r[0] == s)]}.values())
        attempts = [(s, rnd.randint(1, 2), f"b{rnd.randint(0, 1)}", rnd.choice(PERMS))
                    for s in rnd.sample(range(0, 90), 30)]
        lg = spark.createDataFrame(log, "seq long, member long, resource string, role string, action string")
        at = spark.createDataFrame(attempts, "seq long, member long, resource string, permission string")
        rp = spark.createDataFrame(literals.ROLE_PERMISSIONS, "role string, permission string")
        got = {r.attempt_seq: r.allowed for r in A.check_access(at, lg, rp).collect()}
        assert got == brute_access(log, attempts), seed


def brute_health(rows, up, down, delay):
    by = {}
    for pid, inst, t, ok, lat in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        by.setdefault(inst, []).append((pid, t, ok and lat <= 5.0))
    out = {}
    for inst, ps in by.items():
        first = ps[0][1]
        run_ok, run, state = None, 0, "UNKNOWN"
        for pid, t, ok in ps:
            if t - first < delay:
                out[pid] = "UNKNOWN"
                continue
            run = run + 1 if ok == run_ok else 1
            run_ok = ok
            if ok and run >= up:
                state = "HEALTHY"
            elif not ok and run >= down:
                state = "UNHEALTHY"
            out[pid] = state
    return out


def test_health_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(scan, "HOT_ROWS", 16)  # instances are split
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    for seed, (up, down) in enumerate([(2, 2), (3, 1), (1, 3)]):
        rnd = random.Random(100 + seed)
        rows = [(i, rnd.randint(0, 2), rnd.randint(0, 4000), rnd.random() < 0.7, rnd.choice([0.1, 0.1, 9.0]))
                for i in range(150)]
        df = spark.createDataFrame(
            [(p, i, t0 + dt.timedelta(seconds=s), ok, lat) for p, i, s, ok, lat in rows],
            "probe_id long, instance long, ts timestamp_ntz, ok boolean, latency_s double")
        out = H.health_state(H.probe_outcomes(df), up, down)
        got = {r.probe_id: r.state for r in out.collect()}
        assert got == brute_health(rows, up, down, 60), seed


def test_scan_widths(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 3), i, rnd.randint(0, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, seq long, v int")
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r.k, r.seq): r.s for r in df.select("k", "seq", F.sum("v").over(w).alias("s")).collect()}
    for hot_rows in (2, 7, 64, 1000):
        got = {(r.k, r.seq): r.s for r in running(df, ["k"], ["seq"], {"s": ("sum", F.col("v"))},
                                                  hot_rows=hot_rows).collect()}
        assert got == want, hot_rows
