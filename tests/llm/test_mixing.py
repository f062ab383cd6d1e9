import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import COLUMNS, edge_docs, edge_rows, empty_docs

from skyledger.llm import mixing as M


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_permutations_are_bijections():
    for n in (1, 2, 3, 4, 5, 64, 1000, 4097):
        for key in (0, 7):
            assert sorted(M.permute(np.arange(n), n, key).tolist()) == list(range(n))
    assert M.permute(np.arange(50), 50, 1).tolist() != M.permute(np.arange(50), 50, 2).tolist()


def test_targets():
    assert M.share([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    assert M.share([10, 100, 100], [5, 2, 1]) == [30.0, 120.0, 60.0]  # the first stops at 3 x 10
    assert M.share([0, 0], [5, 2]) == [0.0, 0.0] and M.share([], []) == []
    sizes = [1, 2, 3, 500, 700, 10_000]
    targets = M.share(sizes, [5, 2, 1, 5, 2, 1])
    assert abs(sum(targets) - sum(sizes)) < 1e-6 and all(t <= 3 * s + 1e-9 for t, s in zip(targets, sizes))


def check(rows, docs):
    sources = sorted({s for _, _, s in docs}, key=lambda s: (s is None, (s or "").encode()))
    totals = Counter()
    for _, text, source in docs:
        totals[source] += size(text)
    weights = [(5, 2, 1)[i % 3] for i in range(len(sources))]
    target = dict(zip(sources, M.share([totals[s] for s in sources], weights)))
    assert sorted([(r.doc_id, r.size) for r in rows], key=str) == sorted([(d, size(t)) for d, t, _ in docs], key=str)
    taken = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source_size, round(r.target, 6)] += r.taken
    for s in sources:
        same = [x for x in sources if (totals[x], round(target[x], 6)) == (totals[s], round(target[s], 6))]
        got = taken[totals[s], round(target[s], 6)] / len(same)
        assert abs(got - target[s]) <= 0.01 * target[s] + 3, (s, got, target[s])


def test_mix_meets_targets_and_repeats(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = M.mix(docs).collect()
    check(rows, [(r.doc_id, r.text, r.source) for r in docs.collect()])
    assert sorted(rows) == sorted(M.mix(docs.repartition(7)).collect())
    many = M.mix(docs, shard_slots=300).collect()  # many shards: independent draws, exact totals
    check(many, [(r.doc_id, r.text, r.source) for r in docs.collect()])


def test_buckets_of_a_source_agree_with_one(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    monkeypatch.setattr(M, "BUCKET_ROWS", 3)
    rows = M.mix(docs).collect()
    check(rows, [(r.doc_id, r.text, r.source) for r in docs.collect()])
    plan = M.Mix(docs)
    laid = defaultdict(list)
    for r in plan.documents().collect():
        laid[r.source_no].append((r.start, r.size))
    for s, spans in laid.items():
        at = 0
        for start, n in sorted(spans):
            assert start == at
            at += n
        assert at == plan.sizes[s]


def test_mixed_documents_hold_the_words_taken(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    taken = {r.doc_id: r.taken for r in M.mix(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = Counter()
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        assert r.n_chars == len(r.text)
        assert not Counter(r.text.split()) - Counter(texts[r.doc_id].split())
        got[r.doc_id] += size(r.text)
    assert all(got[d] == t for d, t in taken.items())


def test_edges(spark):
    check(M.mix(edge_docs(spark)).collect(), [(r[0], r[1], r[3]) for r in edge_rows()])
    assert M.mix(empty_docs(spark)).count() == 0
    assert M.mixed_documents(empty_docs(spark).select(COLUMNS)).count() == 0
    mixed = M.mixed_documents(edge_docs(spark))
    assert mixed.columns == edge_docs(spark).columns and mixed.count() > 0
    same = spark.createDataFrame([(1, "a b c d e", "s")] * 40 + [(2, "f g", "t")], "doc_id long, text string, source string")
    check(M.mix(same.repartition(4)).collect(), [(1, "a b c d e", "s")] * 40 + [(2, "f g", "t")])
    with pytest.raises(ValueError):
        M.mix(edge_docs(spark), max_sources=1)


def plain_place(i, n, key):
    """The same four rounds with whole numbers, one index at a time."""
    mod = 1 << 64

    def scramble(x):
        x = (x ^ x >> 30) * int(M._M1) % mod
        x = (x ^ x >> 27) * int(M._M2) % mod
        return x ^ x >> 31

    half = max(1, ((n - 1).bit_length() + 1) // 2)
    rounds = [scramble((key + r * 0x9E3779B97F4A7C15) % mod) for r in range(1, 5)]
    while True:
        left, right = i >> half, i & (1 << half) - 1
        for r in rounds:
            left, right = right, left ^ scramble(right ^ r) & (1 << half) - 1
        i = left << half | right
        if i < n:
            return i


def test_words_taken_equal_a_plain_recomputation(spark):
    """Every source has the slots up to its quota, whatever the shards drew; slot j takes the block at
    its place in pass j div blocks; a document's words are counted block by block."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = M.Mix(docs, block_words=64, shard_slots=500)
    times = []
    for s, (n, quota) in enumerate(zip(plan.blocks, plan.quota)):
        count = Counter(plain_place(j % n, n, M.SEED + 1_000_003 * s + j // n) for j in range(quota))
        assert max(count.values(), default=0) <= M.MAX_REPEATS
        times.append(count)
    want = sorted((r.doc_id, sum(times[r.source_no][w // r.block_words] for w in range(r.start, r.start + r.size)))
                  for r in plan.documents().collect())
    got = sorted((r.doc_id, r.taken) for r in M.mix(docs, block_words=64, shard_slots=500).collect())
    assert got == want and sum(t for _, t in got) > 0
