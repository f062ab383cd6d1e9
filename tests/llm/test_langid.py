import random

import numpy as np
from helpers import COLUMNS, edge_docs, edge_rows, empty_docs

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from skyledger.llm import langid as L


def plain_bundle(text, dimensions):
    """Letter by letter: the sum of rotate²(a) * rotate(b) * c over trigrams with a letter in the middle."""
    out = np.zeros(dimensions)
    codes = [0] + [ord(c.lower()) if c.isalpha() and len(c.lower()) == 1 else ord(c) if c.isalpha() else 0
                   for c in text or ""] + [0]
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        if b:
            x, y, z = (L.letter_vector(v, dimensions) for v in (a, b, c))
            out += np.roll(x, 2) * np.roll(y, 1) * z
    return out


def test_bundles_equal_the_plain_sum(monkeypatch):
    texts = ["Hello, World!", None, "", "été ñandú ß", "123", "aa aa", "日本 語", "ab" * 50]
    want = np.array([plain_bundle(t, 256) for t in texts])
    assert (L.bundles(texts, range(len(texts)), len(texts), 256) == want).all()
    monkeypatch.setattr(L, "BLOCK_CHARS", 7)
    monkeypatch.setattr(L, "CELLS", 9)
    monkeypatch.setattr(L, "TRIGRAMS", 5)
    assert (L.bundles(texts, range(len(texts)), len(texts), 256) == want).all()


def test_training_sums_and_prediction(spark):
    rows = [("the cat and the hat", "en"), ("le chat et la mer", "fr"), ("the dog", "en"), (None, "fr"), ("x", None)]
    names, unit = L.train(spark.createDataFrame(rows, "text string, lang string").repartition(3), 512)
    assert names == ["en", "fr"]
    for name, row in zip(names, unit):
        total = sum(plain_bundle(t, 512) for t, lang in rows if lang == name and t)
        assert np.allclose(row, total / np.linalg.norm(total))
    docs = spark.createDataFrame([(1, "the mat"), (2, "la mer"), (3, None), (4, "12 !")], "doc_id long, text string")
    got = {r.doc_id: r for r in L.identify(docs, names, unit).collect()}
    for d, text in ((1, "the mat"), (2, "la mer")):
        v = plain_bundle(text, 512)
        cosine = unit @ v / np.linalg.norm(v)
        assert got[d].lang_pred == names[int(cosine.argmax())] and abs(got[d].score - cosine.max()) < 1e-6
    assert (got[3].lang_pred, got[3].score, got[4].lang_pred) == ("und", 0.0, "und")


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = contract.queries()["op2_language_id"](spark, sf).collect()
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    tested = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert len(tested) > 150 and np.mean(tested) > 0.95


def test_edges(spark):
    names, unit = L.train(L.train_split(edge_docs(spark)))
    rows = L.identify(edge_docs(spark), names, unit).collect()
    assert len(rows) == len(edge_rows())
    assert all(r.lang_pred == "und" for r in rows if r.doc_id in (1, 2, 3, 6))
    assert all(r.held_out for r in rows if r.doc_id is None)
    kept = L.keep_identified(edge_docs(spark).select(COLUMNS), names, unit)
    assert kept.columns == COLUMNS and not {1, 2, 3, 6} & {r.doc_id for r in kept.collect()}
    names, unit = L.train(L.train_split(empty_docs(spark)))
    assert names == [] and L.identify(edge_docs(spark), names, unit).filter("lang_pred <> 'und'").count() == 0
    assert L.identify(empty_docs(spark), names, unit).count() == 0


def test_only_texts_that_can_be_judged_are_rejected(spark):
    names, unit = L.train(spark.createDataFrame([("the cat and the hat sat there with them " * 20, "en")],
                                                "text string, lang string"))
    rows = [(1, "Avec."), (2, "the cat"), (3, "zqx wvk " * 40), (4, "漢字仮名 " * 60), (5, "漢字"), (6, "the hat and " * 30), (7, "1 2 3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in L.keep_identified(docs, names, unit).collect()} == {1, 2, 5, 6}


def spread_text(seed, n, first=0x4E00):
    """Two-letter words of a language of 2,000 letters, frequent ones more often."""
    rng, fixed = random.Random(seed), random.Random(first)
    vocabulary = ["".join(chr(first + fixed.randrange(2000)) for _ in range(2)) for _ in range(4000)]
    return "".join(vocabulary[int(4000 * rng.random() ** 2)] for _ in range(n // 2))


def test_learned_texts_of_a_language_of_many_letters_stay(spark):
    english = "the cat and the hat sat there with them "
    rows = [(i, spread_text(i, 210 + i), "zh") for i in range(150)]
    rows += [(i, english * (6 + i % 5), "en") for i in range(150, 200)] + [(200, None, "zh"), (201, "1 2 " * 80, "zh")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, unit = L.train(L.train_split(docs))
    low = [r for r in L.identify(docs, names, unit).filter("held_out").collect() if r.score <= 3 / 32 and r.doc_id < 200]
    assert len(low) > 5  # rejected by a bound for random vectors
    kept = pipeline.language_id(spark, docs, "").collect()
    assert {r.doc_id for r in kept} == set(range(200)) and len(kept) == 200


def test_fitted_bounds_still_reject(spark):
    english = "the cat and the hat sat there with them "
    rows = [(i, english * (6 + i % 5), "en") for i in range(50)]
    rows += [(50, "zqx wvk " * 40, None), (51, spread_text(1, 300), None), (52, "zqx", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in pipeline.language_id(spark, docs, "").collect()} == {*range(50), 52}


def test_where_nothing_was_learned_letters_stay(spark):
    docs = spark.createDataFrame([(1, "word " * 100), (2, "12 !!"), (3, None), (4, "x")], "doc_id long, text string")
    kept = L.keep_identified(docs, [], np.zeros((0, L.DIMENSIONS)))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4]


def test_judged_length_is_a_parameter(spark):
    names, prototypes = ["en"], np.ones((1, L.DIMENSIONS)) / L.DIMENSIONS ** 0.5
    docs = spark.createDataFrame([(1, "zq xw vk jj " * 12)], "doc_id long, text string")  # 144 characters
    assert L.keep_identified(docs, names, prototypes).count() == 1
    assert L.keep_identified(docs, names, prototypes, judged_chars=100).count() == 0
