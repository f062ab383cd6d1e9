import numpy as np
import pytest
from oracle import both
from pyspark.sql import functions as F

import __spark_entry__ as contract
from skyledger.llm import negatives as N

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, label int, embedding array<double>, cell string, block long, mark string, wanted int"


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for high, dim in ((3, 5), (256, 64), (1 << 20, 3000), (1 << 40, 2), (1 << 62, 7)):
        a, b = rng.integers(-high, high, (4, dim)), rng.integers(-high, high, (5, dim))
        want = a.astype(object) @ b.T.astype(object)
        wrapped = [[(int(x) + (1 << 63)) % (1 << 64) - (1 << 63) for x in r] for r in want]
        assert N.Block(b).scores(a).tolist() == wrapped
    edge = np.array([[np.iinfo(np.int64).min, np.iinfo(np.int64).max, -1]])
    assert N.Block(edge).scores(edge).tolist() == [[sum(int(x) ** 2 for x in edge[0]) % (1 << 64)]]
    assert N.Block(np.zeros((2, 0), np.int64)).scores(np.zeros((3, 0), np.int64)).tolist() == [[0, 0]] * 3


def plain(rows, anchors, positives=5, negatives=3):
    rows = sorted({(i, str(lab), tuple(v)) for i, lab, v in rows
                   if None not in (i, lab, v) and all(x is not None and abs(x) < INF for x in v)})
    rows = [(i, lab, tuple(int(np.floor(256 * x)) for x in v)) for i, lab, v in rows]
    rows = sorted(set(rows))
    out = []
    for a in rows:
        if not anchors(a[0]):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1]) for r in rows
                        if r != a and len(r[2]) == len(a[2]))
        for s, p, _ in [r for r in scored if r[2] == a[1]][:positives]:
            window = [r for r in scored if r[2] != a[1] and 50 * -s <= 100 * -r[0] <= 95 * -s][:negatives]
            out += [(a[0], p, k + 1, r[1], -s, -r[0]) for k, r in enumerate(window)]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame([(*r, "c", 1, "m", 2) for r in rows], SCHEMA)
    floors = F.transform("embedding", lambda x: F.floor(x * 256.0).cast("long"))
    got = N.mine(N.labelled_rows(df, floors, F.col("label")), F.col("vec_id") % 5 == 0)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("block", [64, 1 << 21])
def test_against_all_products(spark, monkeypatch, block):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(4, 6))
    rows = [(i, int(rng.integers(0, 4)) if i % 3 else 0, (centre[i % 4] + 0.6 * rng.normal(size=6)).round(2).tolist())
            for i in range(240)]  # label 0 holds more than a third
    rows += [(300 + i, 1, rows[7][2]) for i in range(40)] + [(400 + i, 2, rows[7][2]) for i in range(40)]  # copies, ties
    monkeypatch.setattr(N, "BLOCK_COMPONENTS", block)
    want = plain(rows, lambda i: i % 5 == 0)
    assert len(want) > 200 and mined(spark, rows) == want


def test_rows_that_take_no_part(spark):
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (0, 2, [1.0, 0.5]), (None, 1, [1.0, 1.0]), (1, None, [1.0, 1.0]),
            (2, 1, None), (3, 1, [1.0, None]), (4, 2, [NAN, 1.0]), (6, 1, [INF, 1.0]), (7, 1, [1.0, 0.25]),
            (8, 2, [0.75, 0.1]), (9, 2, [0.75, 0.1, 0.3]), (10, 1, [-1.0, 0.0]), (11, 3, []), (15, 3, []), (12, 4, [])]
    assert mined(spark, rows) == plain(rows, lambda i: i % 5 == 0)
    assert mined(spark, rows[:2]) == [] and mined(spark, []) == []


def test_oracle(spark):
    got, want = both(spark, "op12_hard_negatives", "/root/testdata/sf0.01")
    assert got == want and len(got) > 0


def test_query_columns(spark):
    df = contract.queries()["op12_hard_negatives"](spark, "/root/testdata/sf0.001")
    assert dict(df.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                               "positive_score": "bigint", "negative_score": "bigint"}
