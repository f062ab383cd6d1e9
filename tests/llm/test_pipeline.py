import re
from collections import Counter

import public_tokenizers
from helpers import COLUMNS, edge_docs, edge_rows
from test_packing import check as packed_right
from test_secret_scan import plain_spans
from test_simhash import plain_rows

import corpus_pipeline as pipeline
from skyledger.llm import langid as L
from skyledger.llm import mixing as M

SF = "/root/testdata/sf0.001"


def plain_redact(text):
    at, out = 0, []
    for a, b in sorted(tuple(map(int, s.split(":")[1:])) for s in plain_spans(text)):
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def run_stages(spark, docs, sf, tmp):
    """Each stage on what the one before it kept, checked against a plain version of its own."""
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    before, seen = docs, {}
    for name, stage in pipeline.STAGES:
        path = f"{tmp}/{name}"
        stage(spark, before, sf).write.parquet(path)
        after = spark.read.parquet(path)
        if name != "packing":
            assert after.columns == docs.columns
        if name == "language_id":
            names, unit = L.train(L.train_split(before))
            vectors = {t: L.bundles([t], [0], 1, L.DIMENSIONS)[0] for _, t in rows(before)}
            score = {t: max(unit @ v) / max((v @ v) ** 0.5, 1e-12) if names else 0 for t, v in vectors.items()}
            want = [(d, t) for d, t in rows(before) if t and re.search(r"[^\W\d_]", t)
                    and (not names or score[t] > 3 / 32 or len(t) < 200)]
            assert Counter(rows(after)) == Counter(want)
        elif name == "near_duplicates":
            want = {c for _, _, c in plain_rows(rows(before))}
            got = rows(after)
            assert len(got) == len(want) and {d for d, _ in got} == want and set(got) <= set(rows(before))
        elif name == "secret_scan":
            assert Counter(rows(after)) == Counter((d, plain_redact(t)) for d, t in rows(before))
            assert all(r.n_chars == len(r.text) for r in after.collect() if "[SECRET]" in r.text)
        elif name == "source_mixing":
            texts, got = dict(rows(before)), Counter()
            for d, t in rows(after):
                got[d] += len(re.findall(M.WORD, t))
                assert not Counter(t.split()) - Counter(texts[d].split())
            taken = Counter()
            for r in M.mix(before).collect():
                taken[r.doc_id] += r.taken
            assert +got == +taken
        else:
            packed_right_many(after.collect(), rows(before))
        seen[name], before = after.count(), after
    return seen, before


def packed_right_many(pieces, docs):
    """As packed_right, for a doc_id that comes in several rows."""
    once = [d for d, n in Counter(d for d, _ in docs).items() if n == 1]
    packed_right([p for p in pieces], docs, 4096)
    assert {p.doc_id for p in pieces} >= set(once) and public_tokenizers


def test_stages_on_a_table(spark, tmp_path):
    seen, result = run_stages(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF, str(tmp_path))
    assert list(seen) == ["language_id", "near_duplicates", "secret_scan", "source_mixing", "packing"]
    assert sorted(result.collect(), key=str) == sorted(pipeline.run(spark, SF).collect(), key=str)


def test_stages_on_edges(spark, tmp_path):
    docs = edge_docs(spark).drop("score", "row")
    run_stages(spark, docs, SF, str(tmp_path))
    assert COLUMNS == docs.columns[:5] and len(edge_rows()) == docs.count()


def test_empty_table(spark, tmp_path):
    docs = edge_docs(spark).limit(0)
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0
