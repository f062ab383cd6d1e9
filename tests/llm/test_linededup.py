import random

import pytest
from helpers import SCHEMA, edge_docs, edge_rows, empty_docs
from oracle import both
from pyspark.sql import functions as F

from skyledger.llm import linededup as L

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def plain(rows, least=L.MIN_CHARS):
    owner = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            owner[key(line)] = min(owner.get(key(line), L.LAST_ID), L.LAST_ID if d is None else d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or owner[key(x)] >= (L.LAST_ID if d is None else d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def line_rows(n=400):
    rng = random.Random(2)
    stock = ["a line that many documents share", "  A Line That MANY documents share\t\r", "ÀÉ letters beyond ascii stay",
             "àÉ letters beyond ascii stay", "short", "nine char", "ten chars!", "", "   ", "\x0bfeed\x0c", "日本語の行は十文字以上あります"]
    texts = ["\n".join(rng.choice([rng.choice(stock), f"own line number {rng.randint(0, 300)}"])
                       for _ in range(rng.randint(0, 12))) for _ in range(n)]
    rows = [(rng.choice([i, i, i, 7, None]), t) for i, t in enumerate(texts)]
    return rows + rows[:20] + [(1000 + i, "a line that many documents share\n" * 30) for i in range(40)]


@pytest.mark.parametrize(("batches", "fanout", "hot"), [(1, 2, 4096), (4, 2, 1), (9, 3, 10)])
def test_against_the_plain_version(spark, monkeypatch, batches, fanout, hot):
    monkeypatch.setattr(L, "HOT_LINES", hot)
    rows = line_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(L.drop_repeated_lines(docs, batches=batches, fanout=fanout)) == plain(rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("llm_lines_")]


def test_runs_are_levelled_and_hold_a_key_once(spark):
    runs = L.LineRuns(spark, buckets=3, fanout=3)
    shapes = []
    for b in range(10):
        lines = spark.createDataFrame([(h, -h, 10 * b + i, 0, i) for i in range(5) for h in (b, b + 1, 100 + i)],
                                      "h1 long, h2 long, doc long, text_hash long, pos int")
        runs.add(lines, 15)
        shapes.append([len(level) for level in runs.levels])
        held = [tuple(r) for name in runs.runs() for r in spark.table(name).collect()]
        assert len({r[:2] for r in held}) == len(held) == b + 7
    assert shapes[:4] == [[1], [2], [0, 1], [1, 1]] and shapes[8:] == [[0, 0, 1], [1, 0, 1]]
    runs.close()


def test_runs_meet_without_a_shuffle(spark):
    runs = L.LineRuns(spark, buckets=8)
    lines = spark.range(50).selectExpr("id as h1", "id as h2", "id as doc", "0L as text_hash", "0 as pos")
    runs.add(lines, 50)
    a, b = spark.table(runs.runs()[0]), spark.table(runs.runs()[0])
    plan = a.join(b.hint("merge"), L.KEY, "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    runs.close()


def test_edge_rows(spark):
    assert got(L.drop_repeated_lines(edge_docs(spark))) == plain([(r[0], r[1]) for r in edge_rows()])
    out = L.drop_repeated_lines(empty_docs(spark))
    assert out.collect() == [] and out.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    short = spark.createDataFrame([(1, "a\nb"), (2, None)], "doc_id long, text string")
    assert got(L.drop_repeated_lines(short)) == [(1, 2, 0, "a\nb"), (2, 1, 0, "")]
    assert SCHEMA.startswith("doc_id")


def test_least_length_is_a_parameter(spark):
    rows = [(1, "abc\nab"), (2, "ABC \nab"), (3, "abc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(L.drop_repeated_lines(docs, min_chars=3)) == plain(rows, 3)


def test_no_python_in_the_plan(spark):
    df = L.drop_repeated_lines(spark.createDataFrame(line_rows(30), "doc_id long, text string")).select(F.sha2("kept", 256))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_oracle(spark):
    have, want = both(spark, "op13_line_dedup", "/root/testdata/sf0.01")
    assert have == want and sum(r[2] for r in have) > 0
