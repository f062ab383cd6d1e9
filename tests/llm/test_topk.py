import numpy as np
import pytest
from oracle import both

from skyledger.llm import topk as T
from skyledger.llm.vectors import smallest_copies, usable

NAN, INF = float("nan"), float("inf")


def plain(queries, vectors, k):
    out = []
    for qid, q in queries:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in vectors if i != qid and len(v) == len(q))
        out += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("shape", ["equal", "spread", "cluster", "ties"])
def test_a_cell_against_all_products(shape):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(700, 8))
    if shape == "equal":
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    elif shape == "spread":
        v *= rng.exponential(size=(700, 1)) ** 3
    elif shape == "cluster":
        v = v[:5][rng.integers(0, 5, 700)] + 0.05 * v
    v = np.floor(v * (3 if shape == "ties" else 1024)).astype(np.int64)
    v[:3] = 0
    ids = rng.permutation(700)
    q = np.concatenate([v[:40], -v[40:50]])
    number, found, score = T.cell_top(q, ids[:50], v, ids, 10)
    got = sorted((int(ids[:50][n]), int(s), int(i)) for n, i, s in zip(number, found, score))
    want = plain([(int(i), r.tolist()) for i, r in zip(ids[:50], q)], [(int(i), r.tolist()) for i, r in zip(ids, v)], 10)
    assert got == sorted((a, s, i) for a, _, i, s in want)


def test_large_components_stay_exact():
    v = np.array([[1 << 30, 1], [1 << 30, 0], [1 << 30, 2]], dtype=np.int64)
    _, found, score = T.cell_top(v[:1], np.array([9]), v, np.array([1, 2, 3]), 2)
    assert found.tolist() == [3, 1] and score.tolist() == [(1 << 60) + 2, (1 << 60) + 1]


def test_query_against_sql(spark):
    got, want = both(spark, "op4_norm_buckets", "/root/testdata/sf0.01")
    assert got == want and len(got) == 50


def test_blocks_agree_with_one(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, [int(x) for x in rng.integers(-50, 50, 6)]) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    want = plain(rows[:30], rows, 5)
    monkeypatch.setattr(T, "BLOCK_ROWS", 40)
    monkeypatch.setattr(T, "QUERY_ROWS", 7)
    assert sorted(tuple(r) for r in T.top_k(frame, frame.filter("vec_id < 30"), 5).collect()) == want


def test_edges(spark):
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (100, [1.0, -1.0], 1), (1, None, 1), (2, [None, 1.0], 1),
            (3, [NAN, 1.0], 1), (4, [INF, 1.0], 1), (None, [1.0, 1.0], 1), (5, [1.0], 1), (200, [], 1), (6, [], 1),
            (7, [1.0, 2.0], 1), (8, [1.0, 2.0], 1), (300, [0.0, 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    v = T.to_integers(usable(frame), 1024)
    keep = {0: [1024, 2048], 100: [1024, -1024], 5: [1024], 200: [], 6: [], 7: [1024, 2048], 8: [1024, 2048], 300: [0, 0]}
    assert {r.vec_id: r.vector for r in v.collect()} == keep
    got = T.top_k(smallest_copies(v, "vector", 3), v.filter("vec_id % 100 = 0"), 2).collect()
    assert sorted(tuple(r) for r in got) == plain([x for x in keep.items() if x[0] % 100 == 0], keep.items(), 2)
    assert T.top_k(v.limit(0), v.limit(0), 2).count() == 0


def test_copies_lose_nothing(spark):
    rows = [(i, [1.0, 1.0]) for i in range(50)] + [(i, [0.5, float(i)]) for i in range(50, 60)]
    v = T.to_integers(usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), 4)
    whole = [(r.vec_id, r.vector) for r in v.collect()]
    got = T.top_k(smallest_copies(v, "vector", 11), v.filter("vec_id % 20 = 0"), 10).collect()
    assert sorted(tuple(r) for r in got) == plain([x for x in whole if x[0] % 20 == 0], whole, 10)


def test_rounds_stop_where_no_query_is_reached(spark, monkeypatch):
    """Spread lengths in many rounds: equal to all products, and the short blocks are never joined."""
    rng = np.random.default_rng(6)
    v = np.floor(rng.normal(size=(3000, 6)) * 1000 * np.exp(rng.normal(size=(3000, 1)) * 1.5)).astype(np.int64)
    v[5], v[6] = 0, v[7]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "vec_id long, vector array<bigint>")
    asked, cells = [], T._cells

    def counted(vectors, queries, k, n):
        asked.append((vectors.count(), queries.count()))
        return cells(vectors, queries, k, n)

    monkeypatch.setattr(T, "_cells", counted)
    queries = [(i, v[i].tolist()) for i in range(0, 3000, 100)]
    got = T.top_k(df, spark.createDataFrame(queries, df.schema), 10, round_rows=100).collect()
    want = plain(queries, [(i, r.tolist()) for i, r in enumerate(v)], 10)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want
    assert asked[0][1] == 30 and all(a[1] >= b[1] for a, b in zip(asked, asked[1:]))  # fewer and fewer are asked
    assert sum(n for n, _ in asked) < 3000  # the shortest vectors never meet a query
    joined = sum(n * q for n, q in asked)
    assert joined < 0.6 * 3000 * 30


def test_few_candidates_and_zero_vectors_need_every_round(spark):
    rows = [(0, [0, 0]), (1, [5, 0]), (2, [0, 0]), (3, [-400, 1]), (4, [1, 1])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<bigint>")
    got = T.top_k(df, df, 4, round_rows=1).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == plain(rows, rows, 4)
