import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import edge_docs, edge_rows, empty_docs

from skyledger.llm import substrings as S
from skyledger.llm.grouping import suffix_array

DIGEST = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def plain(rows):
    """Every 50-byte string looked up one by one."""
    docs = [(d, (t or "").encode()) for d, t in rows]
    least = {}
    for d, t in docs:
        for i in range(len(t) - 49 if d is not None else 0):
            least[t[i:i + 50]] = min(d, least.get(t[i:i + 50], d))
    out = []
    for d, t in docs:
        gone = bytearray(len(t))
        for i in range(len(t) - 49 if d is not None else 0):
            if least[t[i:i + 50]] < d:
                gone[i:i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((d, len(t), len(t) - len(kept), sum(1 for s in bytes(gone).split(b"\0") if s),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(DIGEST).collect()), key=str)


def test_suffix_array_against_sorting():
    rng = random.Random(4)
    for _ in range(3000):
        text = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randrange(40))]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
    for text in ([0] * 300, [0, 1] * 150, list(range(100)), list(range(100, 0, -1)), [2, 1, 0] * 70):
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def passages(seed, n):
    """Texts that share passages of every length around the window, with runs and edits."""
    rng = random.Random(seed)
    pool = ["".join(rng.choice("ab cé") for _ in range(rng.randrange(20, 200))) for _ in range(8)] + ["x" * 130]
    out = []
    for i in range(n):
        text = "".join(rng.choice(pool)[rng.randrange(30):][:rng.randrange(20, 140)] + rng.choice(["", "q", "zz", str(i)])
                       for _ in range(rng.randrange(1, 6)))
        out.append((rng.randrange(n), text))
    return out


@pytest.mark.parametrize("hot", [4096, 2])
def test_shared_passages(spark, hot):
    rows = passages(7, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(S.dedup_substrings(df, part_bytes=2000, hot_above=hot)) == plain(rows)


def test_anchor_keys_fill_all_buckets():
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(5000)).encode() for _ in range(20)]
    key = S.regions(texts)[4]
    size = np.bincount((key >> np.uint64(60)).astype(np.int64), minlength=16)
    assert len(key) > 5000 and size.max() < 1.5 * size.mean() and size.min() > 0.5 * size.mean()


def test_hot_repeated_bytes():
    """A run of one byte has one anchor, over and over; its regions still agree with a plain search."""
    texts = [b"x" * 500, b"y" + b"x" * 120, b"x" * 49, b"x" * 50]
    text, low, high, at, key = S.regions(texts)
    assert sorted(set(text.tolist())) == [0, 1, 3]
    assert sum((high - low + 1)[text == 0]) == 451 and sum((high - low + 1)[text == 3]) == 1


def test_long_text_in_segments(spark):
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(300_000))
    rows = [(1, base[1000:200_000]), (2, "tail " + base), (3, base[131_000:131_072] + "!" + base[262_000:262_200])]
    got = rows_of(S.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), part_bytes=100_000))
    assert got == plain(rows)


def test_query_on_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = S.dedup_substrings(docs, with_text=True)
    assert rows_of(got) == plain(rows)
    texts = dict(rows)
    for r in got.collect():
        raw = texts[r.doc_id].encode()
        kept = b"".join(raw[a:b] for a, b in zip([0, *[s.end for s in r.removed]], [*[s.start for s in r.removed], len(raw)]))
        assert kept == r.kept and r.n_spans == len(r.removed)


def test_edges(spark):
    assert rows_of(S.dedup_substrings(edge_docs(spark))) == plain([r[:2] for r in edge_rows()])
    assert S.dedup_substrings(empty_docs(spark)).count() == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("llm_parts_")]


def test_an_anchor_is_hot_by_all_its_occurrences():
    """63 occurrences in each of three parts are 189, not three."""
    rng = random.Random(8)
    phrase = bytes(rng.choice(b"abcdefgh ") for _ in range(60))
    messages = []
    for part in range(3):
        raw = b"".join(phrase + bytes(rng.choice(b"abcdefgh ") for _ in range(40)) for _ in range(63))
        messages.append(S.send_anchors(pa.table({"part": [part], "doc_id": [part], "raw": [raw]}), 0))
    bucket = pa.concat_tables(messages)
    for above, some in ((188, True), (189, False)):
        hot = S.answer_anchors(bucket, above).column("b")
        assert all((np.frombuffer(h.as_py(), np.uint8) > 0).any() == some for h in hot)
