import numpy as np
from helpers import edge_docs, edge_rows, empty_docs

import __spark_entry__ as contract
from skyledger.llm import quality as Q


def test_indicators():
    assert Q.indicators(None).tolist() == [] and Q.indicators("").tolist() == []
    a, b = Q.indicators("one two one two"), Q.indicators("one two")
    assert set(b[b >= Q.SHAPES]) <= set(a) and len(a) == len(set(a.tolist()))
    assert Q.indicators("One").tolist() != [] and set(Q.indicators("x !! y")) != set(Q.indicators("x y"))
    again = Q._AGAIN
    assert (Q._LOWER << 8 | again << 4 | again) in Q.indicators("na na na")


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 5))
    y = np.where(x[:, 0] + 0.5 * rng.normal(size=60) > 0, 1.0, -1.0)
    rows = [(np.arange(5), r) for r in x]
    w = Q.dual_descent(rows, y, 5, cost=0.5, epochs=3000)

    def loss(w):
        limit = 0.5 / (2 * np.where(y > 0, (y > 0).mean(), (y < 0).mean()))
        return 0.5 * (w * w).sum() + (limit * np.maximum(0, 1 - y * (x @ w[:5] + w[5]))).sum()

    best = loss(w)
    assert all(loss(w + 0.01 * rng.normal(size=6)) > best - 1e-3 for _ in range(200))


def test_log_count_ratios_equal_a_plain_count(spark):
    docs = [(i, f"good word{i % 3} fine" if i % 2 else f"bad word{i % 3} !!") for i in range(60)]
    labels = [(i, i % 2) for i in range(60)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    model = Q.fit(d, spark.createDataFrame(labels, "doc_id long, quality int"))
    held = {r.doc_id for r in d.select("doc_id", Q.held_out(Q.F.col("doc_id")).alias("h")).filter("h").collect()}
    seen = np.ones((2, Q.FEATURES))
    for (i, text), (_, label) in zip(docs, labels):
        if i not in held:
            seen[label, Q.indicators(text)] += 1
    assert np.allclose(model.ratio, np.log(seen[1] / seen[1].sum()) - np.log(seen[0] / seen[0].sum()))
    got = Q.score(d, model).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got) and all(0 <= r.score <= 1 for r in got)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = contract.queries()["op7_nb_svm"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    tested = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    for value in (0, 1):
        assert np.mean([p == value for p, y in tested if y == value]) > 0.95


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 0), (5, 1), (7, None), (8, 3), (None, 1), (99, 0), (3, 0)],
                                   "doc_id long, quality int")
    docs = edge_docs(spark)
    rows = Q.score(docs, Q.fit(docs, labels)).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    empty = [r.score for r in rows if r.doc_id in (1, 2)]
    assert len(set(empty)) == 1
    none = Q.fit(docs, labels.limit(0))
    assert none.w is None and {r.score for r in Q.score(docs, none).collect()} == {0.5}
    one = Q.fit(docs, labels.filter("quality = 1"))
    assert one.w is None and one.prior > 0.5
    assert Q.score(empty_docs(spark), none).count() == 0
