import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from helpers import edge_docs, edge_rows, empty_docs
from tokenizers import Tokenizer

from skyledger.llm import packing as P
from skyledger.llm.tokens import WordBpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, capacity):
    """Round trip: every id of every row of docs lies in exactly one piece, offsets have no gaps."""
    tok = Tokenizer.from_file(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    want = defaultdict(list)
    for d, text in docs:
        want[d].append(tok.encode(text or "", add_special_tokens=False).ids + [2])
    assert set(by_doc) == set(want)
    for d, copies in want.items():
        expected, got = [], sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[d])
        assert sum(g[1] for g in got) == sum(map(len, copies))
        if len(copies) == 1:
            at = 0
            for start, length, crc, total in got:
                assert start == at and total == len(copies[0])
                at += length
                assert crc == zlib.crc32(struct.pack(f"<{length}I", *copies[0][start:at]))
            assert at == len(copies[0]), expected
    padding = tokens = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        tokens += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / max(1, tokens)


@pytest.mark.parametrize("text", [
    "Hello, it's 1234 o'clock!", "ÉCOLE Straße ŒUVRE İstanbul ŉ Ǆ", "a b c\x85d\x1ce", "<|endoftext|> x<|startoftext|>y",
    "日本語 العربية ελληνικός ΣΑΣ", "é ́ Å ﬁ", "x" * 500, "'re 'S I'LL don't", "tab\tnew\nline\r\n\x0b\x0c", "😀 a_b-c"])
def test_ids_equal_the_tokenizer(text):
    got = WordBpe(PATH).ids(text.encode())
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_long_text_in_slices(monkeypatch):
    monkeypatch.setattr("skyledger.llm.tokens.SLICE_BYTES", 50)
    text = "The quick brown fox, it's " * 40
    got = WordBpe(PATH).ids(text.encode())
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_pieces_cover_and_fit_their_class():
    for n in [*range(1, 300), 1365, 1366, 2047, 2048, 2049, 4095, 4096, 4097, 12_345]:
        pieces = list(P.pieces(n))
        assert sum(length for length, _ in pieces) == n
        assert all(4096 // (i + 1) < length <= 4096 // i or length == 4096 // i for length, i in pieces)


def test_round_trip_on_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = P.pack(docs, PATH).collect()
    assert check(rows, [(r.doc_id, r.text) for r in docs.collect()], 4096) < 0.005


def test_edges(spark):
    rows = P.pack(edge_docs(spark).repartition(3), PATH, capacity=64).collect()
    check(rows, [r[:2] for r in edge_rows()], 64)
    with_ids = P.pack(edge_docs(spark), PATH, with_ids=True).collect()
    assert all(len(r.ids) == r.length for r in with_ids)
    assert P.pack(empty_docs(spark), PATH).count() == 0
    with pytest.raises(ValueError):
        P.pack(edge_docs(spark), PATH, capacity=100)
