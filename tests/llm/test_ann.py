from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import __spark_entry__ as contract
from skyledger.llm import ann as A
from skyledger.llm.vectors import usable


def recall(rows, ids, x, queries, k):
    got, hit, total = defaultdict(list), 0, 0
    for r in sorted(rows):
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    for q in queries:
        score = A.exact_scores(np.repeat(x[q][None, :], len(x), axis=0), x)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
        found = got[ids[q]]
        assert [r for r, _, _ in found] == list(range(1, len(order) + 1))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        place = {int(i): n for n, i in enumerate(ids)}
        assert all(s == score[place[i]] for _, i, s in found)
        hit += len({i for _, i, _ in found} & {int(ids[i]) for i in order})
        total += len(order)
    return hit / total


def frame(spark, ids, x):
    return spark.createDataFrame(pa.table({"vec_id": ids, "embedding": pa.array(x.tolist(), pa.list_(pa.float64()))}))


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    got = contract.queries()["op8_posting_lists"](spark, sf).collect()
    assert recall(got, ids, x, np.nonzero(ids % 20 == 0)[0], 20) >= 0.9


def test_recall_with_clusters_lengths_and_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(A, "GROUP_ROWS", 500)  # long lists are split, groups hold few lists
    monkeypatch.setattr(A, "QUERY_ROWS", 50)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(30, 16))[rng.integers(0, 30, 4000)] + 0.3 * rng.normal(size=(4000, 16))
    x *= rng.uniform(0.5, 2, size=(4000, 1))
    x[1000:2400] = x[1000]  # a third are copies of one vector
    ids = rng.permutation(4000)
    got = A.search(frame(spark, ids, x), F.col("vec_id") % 20 == 0, 20).collect()
    assert recall(got, ids, x, np.nonzero(ids % 20 == 0)[0], 20) >= 0.9


def test_graph_walk_finds_near_centroids():
    rng = np.random.default_rng(9)
    centroids = rng.normal(size=(300, 12))
    points = rng.normal(size=(50, 12))
    lists, far = A.graph_search(points, centroids, A.neighbour_graph(centroids), 64)
    gap = A.distances(points, centroids)
    assert np.mean([len(set(a.tolist()) & set(np.argsort(b)[:20].tolist())) / 20 for a, b in zip(lists, gap)]) > 0.95
    assert np.allclose(far[:, 0], gap.min(axis=1))
    whole, _ = A.graph_search(points, centroids[:5], A.neighbour_graph(centroids[:5]), 64)
    assert (np.sort(whole, axis=1) == np.arange(5)).all()


def test_postings_replicate_boundaries():
    centroids = np.array([[0.0, 0.0], [10.0, 0.0], [0.0, 10.0]])
    number, lists, first = A.postings_of(np.array([[5.0, 0.1], [0.2, 0.1]]), centroids)
    assert sorted(zip(number.tolist(), lists.tolist(), first.tolist())) == [(0, 0, True), (0, 1, False), (1, 0, True)]


def test_balanced_lists():
    rng = np.random.default_rng(10)
    points = np.concatenate([0.01 * rng.normal(size=(3000, 4)), rng.normal(size=(1000, 4))])
    centroids = A.balanced_centroids(points, 16)
    size = np.bincount(A.distances(points, centroids).argmin(axis=1), minlength=16)
    assert size.max() < 2000 and (size > 0).sum() >= 12


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [0.0, 0.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]),
            (4, [inf, 1.0]), (None, [1.0, 1.0]), (5, [1.0]), (6, []), (7, [1.0, 2.0]), (40, [-1.0, 0.5]), (8, [3.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = A.search(table, F.col("vec_id") % 20 == 0, 20).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 7, 5.0), (0, 2, 8, 3.0), (0, 3, 40, 0.0),
                                             (40, 1, 0, 0.0), (40, 2, 7, 0.0), (40, 3, 8, -3.0)]
    assert A.search(table.limit(0), F.col("vec_id") % 20 == 0, 20).count() == 0
    assert A.search(table, F.col("vec_id") < 0, 20).count() == 0


def test_vectors_between_lists_are_replicated_and_few_postings_are_read(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(20_000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = A.balanced_centroids(A.on_sphere(x[:8000], 1.0), 80)
    assert np.allclose(np.linalg.norm(lists, axis=1), 1)
    number, _, first = A.postings_of(A.on_sphere(x, 1.0), lists)
    assert first.sum() == len(x) and 1.3 < len(number) / len(x) <= A.REPLICAS
    centre = rng.normal(size=(60, 16))
    near = centre[rng.integers(0, 60, 6000)] + 0.2 * rng.normal(size=(6000, 16))
    index = A.Index(usable(frame(spark, np.arange(6000), near)), 10)
    asked, chosen, _ = index.select(A.query_on_sphere(near[:300]))
    assert index.size[chosen].sum() / 300 < 0.25 * index.size.sum()  # of all postings, by a query


def test_query_blocks(monkeypatch):
    monkeypatch.setattr(A, "QUERY_ROWS", 100)
    assert A.query_blocks([40, 50, 30, 250, 10, 0, 90]) == [
        (0, 0, 1), (1, 0, 1), (2, 1, 1), (3, 2, 3), (4, 5, 1), (5, 5, 1), (6, 5, 1)]
    assert A.query_blocks([]) == []
