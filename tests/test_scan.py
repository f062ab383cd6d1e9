"""The bucketed running scan equals a plain per-key window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from skyledger.operators.scan import hot_keys, running


def test_running_equals_window(spark):
    rnd = random.Random(7)
    # one hot key with most rows, a few small keys, nulls in the value
    rows = [(0 if rnd.random() < 0.5 else (None if rnd.random() < 0.2 else rnd.randint(1, 5)), i,
             None if rnd.random() < 0.3 else rnd.randint(-50, 50)) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, seq long, v int")
    got = running(df, ["k"], ["seq"], hot_rows=16, aggs={
        "s": ("sum", F.col("v")), "mx": ("max", F.col("v")), "mn": ("min", F.col("v")),
        "last": ("last", F.col("v"))})
    got_ex = running(df, ["k"], ["seq"], {"prev": ("last", F.col("v"))}, exclusive=True, hot_rows=16)
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    we = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("k", "seq", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("mx"),
                     F.min("v").over(w).alias("mn"), F.last("v", True).over(w).alias("last"),
                     F.last("v", True).over(we).alias("prev"))
    a = {(r.k, r.seq): (r.s, r.mx, r.mn, r.last) for r in got.collect()}
    b = {(r.k, r.seq): (r.prev,) for r in got_ex.collect()}
    for r in want.collect():
        assert a[(r.k, r.seq)] == (r.s, r.mx, r.mn, r.last)
        assert b[(r.k, r.seq)] == (r.prev,)
    assert len(a) == 600


def test_hot_key_is_cut_at_quantiles(spark):
    """Dense, sparse and bunched sequences are cut into buckets of like size; ordinary keys are not."""
    for step in ("id", "id * 1000003", "id * id * id", "cast(id / 10 as bigint)"):
        df = spark.range(0, 5000).selectExpr("1 AS k", f"{step} AS seq", "id").union(
            spark.range(0, 50).selectExpr("2 AS k", "id AS seq", "id"))
        levels = hot_keys(df, ["k"], ["seq"], 400).levels
        cuts = levels[0].collect()
        assert len(levels) == 1 and [r["__key"].k0 for r in cuts] == [1] and 20 <= len(cuts[0]["__cuts"]) <= 25
        edges = [float("-inf"), *cuts[0]["__cuts"], float("inf")]
        values = [r.seq for r in df.filter("k = 1").collect()]
        sizes = [sum(a <= v < b for v in values) for a, b in zip(edges, edges[1:])]
        assert sum(sizes) == 5000 and max(sizes) <= 2 * 5000 / 25
        out = running(df, ["k"], ["seq", "id"], {"n": ("sum", F.lit(1))}, hot_rows=400)
        assert sorted(r.n for r in out.filter("k = 1").collect()) == list(range(1, 5001))
    assert hot_keys(df, ["k"], ["seq"], 6000) is None


def test_buckets_that_are_still_hot_are_cut_again(spark, monkeypatch):
    """With four buckets to a cut, a key of 3,000 rows and buckets of 20 needs several levels."""
    from skyledger.operators import scan
    monkeypatch.setattr(scan, "FAN", 4)
    rnd = random.Random(3)
    rows = [(0 if i % 3 else rnd.choice([1, 2, None]), rnd.randint(0, 10**9), i, None if rnd.random() < 0.3 else rnd.randint(-9, 9))
            for i in range(4500)] + [(3, 5, 10_000 + i, 1) for i in range(100)]  # a key whose rows all tie
    df = spark.createDataFrame(rows, "k int, seq long, id long, v int").cache()
    hot = hot_keys(df, ["k"], ["seq"], 20)
    assert len(hot.levels) >= 4 and all(len(r["__cuts"]) < 4 for level in hot.levels for r in level.collect())
    w = Window.partitionBy("k").orderBy("seq", "id").rowsBetween(Window.unboundedPreceding, 0)
    for exclusive in (False, True):
        frame = w if not exclusive else Window.partitionBy("k").orderBy("seq", "id").rowsBetween(Window.unboundedPreceding, -1)
        want = df.select("id", F.sum("v").over(frame).alias("s"), F.max("v").over(frame).alias("mx"),
                         F.min("v").over(frame).alias("mn"), F.last("v", True).over(frame).alias("last"))
        got = running(df, ["k"], ["seq", "id"], {
            "s": ("sum", F.col("v")), "mx": ("max", F.col("v")), "mn": ("min", F.col("v")), "last": ("last", F.col("v"))},
            exclusive=exclusive, hot=hot).select("id", "s", "mx", "mn", "last")
        assert sorted(got.collect()) == sorted(want.collect())


def test_columns_with_internal_names(spark):
    df = spark.range(100).selectExpr("id % 2 AS __key", "id AS __b0", "id AS __BUCKET", "1 AS __v0", "2 AS __l0", "3 AS __cuts",
                                     "4 AS `a.b`")
    out = running(df, ["__key"], ["__b0"], {"n": ("sum", F.col("__v0"))}, hot_rows=8)
    assert out.columns == [*df.columns, "n"]
    assert sorted((r["__b0"], r.n) for r in out.collect()) == [(i, i // 2 + 1) for i in range(100)]


def test_equal_generations_are_numbered_in_order(spark):
    from skyledger.operators.objects import list_versions
    df = spark.createDataFrame([("a", 1, s) for s in (5, 3, 4)] + [("a", 0, 9)], "name string, generation long, size_bytes long")
    got = sorted((r.version_no, r.generation, r.size_bytes) for r in list_versions(df).collect())
    assert got == [(1, 0, 9), (2, 1, 3), (3, 1, 4), (4, 1, 5)]


def test_size_checks(spark):
    from skyledger.operators.sizing import bounded_broadcast, literal_table, plan_bytes
    from skyledger.sources import literals

    lit = literal_table(spark, literals.SUBNETS, "subnet string, network string, region string, range string")
    assert plan_bytes(lit) < 1 << 20                       # exact, small
    assert lit.count() == len(literals.SUBNETS)
    rdd_backed = spark.createDataFrame(literals.SUBNETS, "a string, b string, c string, d string")
    assert bounded_broadcast(rdd_backed, 1 << 20) is rdd_backed   # unknown size: no broadcast hint
    joined = spark.range(10).withColumn("subnet", F.lit("privatesubnet-us")) \
        .join(bounded_broadcast(lit, 1 << 20), on="subnet")
    assert "Broadcast" in joined._jdf.queryExecution().executedPlan().toString()
