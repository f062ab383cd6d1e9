import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import edge_docs, edge_rows, empty_docs

import __spark_entry__ as contract
from skyledger.llm import align as A

NONE = ([], [], [], "")


@pytest.fixture(scope="module")
def found():
    return A.Aligner(*A.tokenizer_files())


def plain(found, text):
    """Ids, links and groups of a text, token by token, with the tokenizers' own libraries."""
    if not text:
        return NONE
    whole = " " + text
    a, b = found.a.tok.encode(whole, add_special_tokens=False).ids, found.b.tok.encode(text)
    raw_a, raw_b = [found.a.table[i] for i in a], [found.b.table[i] for i in b]
    if b"".join(raw_a) != whole.encode() or b"".join(raw_b) != whole.encode():
        return NONE
    links, groups, here, i, j, end_a, end_b = [], [], ([], []), 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if end_a <= end_b and i < len(a):
            here[0].append(a[i])
            end_a += len(raw_a[i])
            i += 1
        else:
            here[1].append(b[j])
            end_b += len(raw_b[j])
            j += 1
        if end_a == end_b:
            links.append((here[0][-1], here[1][-1]))
            groups.append("|".join(",".join(map(str, ids)) for ids in here))
            here = ([], [])
    return a, b, links, ";".join(groups)


def odd_texts(n):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\r", "\t", "a", "B", "é", "日", "▁", ".", ";", ")", "{", "}", "　", "\xa0", "\x1c", "\x85",
             "12", "the", "<|endoftext|>", "</s>", "<0x0A>", "\x00", "'s", " \n", "\r\n", "😀"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(n)]


@pytest.mark.parametrize("slice_chars", [1, 7, 1 << 20])
def test_texts_against_the_plain_version(found, monkeypatch, slice_chars):
    monkeypatch.setattr(A, "SLICE_CHARS", slice_chars)
    assert found.a.fast and found.b.by_slice
    some = 0
    for text in [None, "", *odd_texts(1500)]:
        a, b, links, groups = plain(found, text)
        n_a, n_b, codes, got = found.text(text)
        assert (n_a, n_b, got) == (len(a), len(b), groups), text
        assert codes.tolist() == [x * len(found.b.table) + y for x, y in links], text
        some += bool(a)
    assert 0 < some < 1500  # some are not given back


def test_tokens_that_end_together_are_suffixes(found):
    for text in odd_texts(300):
        for a, b in plain(found, text)[2]:
            x, y = found.a.table[a], found.b.table[b]
            assert x.endswith(y) or y.endswith(x)
    assert A.most_pairs([b"ab", b"b"], [b"b", b"cab"]) == 4  # b, ab | b; b | b; ab | cab, b | cab


def expected(found, rows):
    texts = [(d, *plain(found, t)) for d, t in rows]
    counts = Counter(link for t in texts for link in t[3])
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return sorted(((d, len(a), len(b), len(links), len(links), sum(counts[x] == highest[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "")
                   for d, a, b, links, groups in texts), key=str)


def test_documents_against_the_plain_version(spark, found):
    got = sorted((tuple(r) for r in A.align_documents(edge_docs(spark), *A.tokenizer_files()).collect()), key=str)
    assert got == expected(found, [(r[0], r[1]) for r in edge_rows()])


def test_groups_come_back(spark, found):
    rows = A.align_documents(edge_docs(spark), *A.tokenizer_files(), with_groups=True).collect()
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in rows if r.groups)
    assert sum(bool(r.groups) for r in rows) > 10


def test_query_against_the_plain_version(spark, found):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in contract.queries()["op11_alignment"](spark, sf).collect()), key=str)
    assert got == expected(found, [tuple(r) for r in docs])


def test_empty_table(spark):
    out = A.align_documents(empty_docs(spark), *A.tokenizer_files())
    assert out.collect() == [] and out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                                   "groups_sha256"]


def test_ends_meet():
    a, b = A.align([1, 3, 4, 9], [2, 3, 9])
    assert np.array_equal(a, [2, 4]) and np.array_equal(b, [2, 3])
