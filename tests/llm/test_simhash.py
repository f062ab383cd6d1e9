import re

import numpy as np
import xxhash
from helpers import edge_docs, edge_rows, empty_docs

import __spark_entry__ as contract
from skyledger.llm import simhash as S


def plain_print(text, shingle=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints, bits):
    """Smallest member of each one's component, all pairs compared."""
    prints = sorted(set(prints))
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def plain_rows(rows, bits=4):
    prints = [plain_print(t) for _, t in rows]
    root = plain_roots(prints, bits)
    first = {}
    for (d, _), p in zip(rows, prints):
        if d is not None:
            first[root[p]] = min(d, first.get(root[p], d))
    return sorted([(d, format(p, "016x"), first.get(root[p])) for (d, _), p in zip(rows, prints)], key=str)


def test_codeword_keys():
    golay, rng = S.Golay(), np.random.default_rng(1)
    words = np.arange(1 << 23, step=97)
    assert (np.bitwise_count((words ^ golay.leader[golay.syndrome[0][words & 0xFFF] ^ golay.syndrome[1][words >> 12]])
                             ^ words) <= 3).all()  # the code is perfect
    for width in (21, 22):
        x = rng.integers(0, 1 << width, 2000)
        y = x ^ (1 << rng.integers(0, width, 2000)) ^ (1 << rng.integers(0, width, 2000))
        for a, b in zip(golay.keys(x, width), golay.keys(y, width)):
            assert set(a[a >= 0]) & set(b[b >= 0])


def test_every_pair_within_four_bits_shares_a_key():
    rng, golay = np.random.default_rng(2), S.Golay()
    for _ in range(300):
        a = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        b = a
        for bit in rng.choice(64, int(rng.integers(1, 5)), replace=False):
            b ^= 1 << int(bit)
        key, at = S.fuzzy_keys(np.array([a, b], dtype=np.uint64).view(np.int64), golay)
        assert set(key[at == 0]) & set(key[at == 1])


def test_links_with_chunks(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 5)  # every crowded key is cut
    monkeypatch.setattr(S, "SHARED_BROADCAST_BYTES", 0)  # and keys are joined by a shuffle
    rng = np.random.default_rng(3)
    prints = set()
    for _ in range(12):
        centre = int(rng.integers(0, 1 << 62)) << 2
        for _ in range(30):
            p = centre
            for bit in rng.choice(64, int(rng.integers(0, 5)), replace=False):
                p ^= 1 << int(bit)
            prints.add(p)
    signed = [int(np.array([p], dtype=np.uint64).view(np.int64)[0]) for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    for bits in (2, 4):
        want = {p: r for p, r in plain_roots([p & (1 << 64) - 1 for p in signed], bits).items()}
        got = {r.node: r.root for r in S.components(S.links(frame, bits)).collect()}
        groups = {}
        for p in signed:
            groups.setdefault(want[p & (1 << 64) - 1], set()).add(got.get(p, p))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = contract.queries()["op6_simhash_golay"](spark, sf).collect()
    assert sorted([tuple(r) for r in got], key=str) == plain_rows(rows)


def test_edges(spark):
    rows = [r[:2] for r in edge_rows()]
    assert sorted([tuple(r) for r in S.near_duplicates(edge_docs(spark)).collect()], key=str) == plain_rows(rows)
    assert S.near_duplicates(empty_docs(spark)).count() == 0
    kept = S.one_per_component(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    want = {c for _, _, c in plain_rows(rows)}
    got = [r.doc_id for r in kept.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_one_row_stays_whatever_the_columns(spark):
    """Repeated and null ids, a map column (which has no order) and names that the operator uses."""
    a, b, c = ("one two three four five six seven", "other words entirely in this text here", "third text of its own kind now")
    rows = [(5, a, {"k": 2}, 1), (5, a, {"k": 1}, 1), (5, b, {}, 2), (9, a, {}, 3), (None, c, {"z": 0}, 4), (None, c, {"y": 0}, 4), (7, b, {}, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp map<string,int>, root int")
    kept = S.one_per_component(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.fp, r.root) for r in kept.collect()), key=str)
    assert got == sorted([(5, a, {"k": 1}, 1), (5, b, {}, 2), (None, c, {"y": 0}, 4)], key=str)


def test_many_ids_that_go_meet_the_rows_by_a_shuffle(spark, monkeypatch):
    rows = [(i, ["same words over and over again", f"text {i} alone " * 9][i % 2], i) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    want = sorted(r.doc_id for r in S.one_per_component(docs).collect())
    monkeypatch.setattr(S, "IDS_BROADCAST", 3)
    assert sorted(r.doc_id for r in S.one_per_component(docs).collect()) == want and 0 in want and 2 not in want
