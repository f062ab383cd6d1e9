import hashlib

from oracle import both
from pyspark.sql import functions as F

from skyledger.llm import fixity as X


def leaves(spark, rows):
    return spark.createDataFrame(rows, "archive long, offset long, record_id long, length long, copies long, digest string")


def test_query_against_sql(spark):
    got, want = both(spark, "op1_merkle_fixity", "/root/testdata/sf0.01")
    assert got == want and len(got) > 3


def test_audit_against_a_plain_comparison(spark):
    rows = [(a, i * 37, i, 37, 1, f"{a}-{i}") for a in range(3) for i in range(200)]
    other = [(a, o, i, n, c, d + ("x" if i % 41 == 3 and a == 1 else "")) for a, o, i, n, c, d in rows if (a, i) != (2, 7)]
    other += [(9, 0, 1, 5, 1, "stray"), (2, 200 * 37, 200, 1, 1, "stray")]
    got = X.audit(leaves(spark, rows), leaves(spark, other), span=100, fanout=3).collect()
    mine, theirs = ({r[:2]: r for r in side} for side in (rows, other))
    want = {k: "lost" if k not in theirs else "stray" if k not in mine else "altered"
            for k in mine.keys() | theirs.keys() if mine.get(k) != theirs.get(k)}
    assert {(r.archive, r.offset): r.status for r in got} == want and len(got) == len(want)
    assert X.audit(leaves(spark, rows), leaves(spark, rows), span=100, fanout=3).count() == 0


def test_tree_hashes(spark):
    rows = [(0, 5, o, f"h{o}") for o in (0, 3, 8, 20)]
    frame = spark.createDataFrame(rows, "replica int, archive long, offset long, leaf string")
    levels = [{r.node: r.hash for r in level.collect()} for level in X.tree(frame, span=4, fanout=2)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    first = {0: sha("0:h0,3:h3"), 2: sha("8:h8"), 5: sha("20:h20")}
    second = {0: sha("0:" + first[0]), 1: sha("2:" + first[2]), 2: sha("5:" + first[5])}
    third = {0: sha(f"0:{second[0]},1:{second[1]}"), 1: sha("2:" + second[2])}
    assert levels[:3] == [first, second, third] and list(levels[-1]) == [0]


def test_manifest_splits_and_counts(spark):
    rows = [(0, 1, 10, f"{i % 9:02x}{i}", "z") for i in range(40)] + [(0, 1, 10, "000", "z")] * 5 + [(0, None, 4, "aa", "z")]
    frame = spark.createDataFrame(rows, "archive long, record_id long, length long, digest string, note string")
    laid = sorted((r.offset, r.length * r.copies) for r in X.manifest(frame, ["note"]).collect())
    at = 0
    for offset, size in laid:
        assert offset == at
        at += size
    assert at == sum(r[2] for r in rows)


def test_edges(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", "h"), (2, "u", ""), (2, "u", ""), (3, "u", "x" * 300_000)],
                                  "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    texts = [r[0] for r in pages.select(X.record(F.col("page_id"), F.col("url"), F.col("html"))).collect()]
    assert all(t.startswith("WARC/1.0\r\n") and t.endswith("\r\n\r\n") for t in texts)
    assert "Content-Length: 300000\r\n" in texts[4]
    none = leaves(spark, [])
    assert X.audit(none, none).count() == 0
    one = leaves(spark, [(0, 0, 1, 5, 1, None)])
    assert [r.status for r in X.audit(one, none).collect()] == ["lost"]
