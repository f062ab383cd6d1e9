import base64
import hashlib
import json
import re

import pytest
from helpers import COLUMNS, edge_docs, edge_rows, empty_docs

import __spark_entry__ as contract
from skyledger.llm import secret_scan as S

PLAIN = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                               re.I | re.A), lambda m: len(m[2]) >= 6),
         ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
         ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]


def plain_spans(text):
    found = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p, good) in enumerate(PLAIN)
             for m in p.finditer(text) if good(m)]
    return [s[2] for s in sorted(found)]


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


RSA = der(0x30, der(2, b"\0") + b"".join(der(2, bytes([i]) * 40) for i in range(1, 9)))
PKCS8 = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x86\x48") + der(5, b"")) + der(4, RSA))
SSH = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-ed25519", b"k" * 32))


def b64(data, url=False):
    return (base64.urlsafe_b64encode if url else base64.b64encode)(data).decode()


def jwt(head):
    return ".".join(b64(json.dumps(x).encode(), True).rstrip("=") for x in (head, {"sub": "1"})) + "." + "s" * 20


def kinds(text):
    return [(s["kind"], text[s["start"]:s["end"]]) for s in S.spans_of(text) if s["kind"] not in S.BASE_KINDS]


def test_structures_are_confirmed():
    for data, kind in ((RSA, "der"), (PKCS8, "der"), (SSH, "ssh")):
        assert kinds(f"x {b64(data)} y") == [(kind, b64(data))]
        assert (kind, data.hex()) in kinds(f"x {data.hex()} y")
    block = f"-----BEGIN RSA PRIVATE KEY-----\n{b64(RSA)[:64]}\n{b64(RSA)[64:]}\n-----END RSA PRIVATE KEY-----"
    assert kinds(f"é {block} z") == [("der", block)]
    assert kinds(f"a {jwt({'alg': 'HS256'})} b") == [("jwt", jwt({"alg": "HS256"}))]


def test_chance_runs_are_not():
    assert kinds(f"x {b64(RSA[:-3])} y") == []  # a length that does not fit
    assert kinds(f"x {b64(RSA + b'zz')}") == []
    assert kinds(jwt({"typ": "none"})) == []
    assert kinds("M" * 60 + " " + "30" * 40 + " " + "eyJ" + "a" * 30 + ".bbbbbb.cccccccccccc") == []


def test_base_semantics():
    for text in ("secret=token:abcdefgh", "token=token=abcdef", "PASSWORD : 'abcdef'", "api_key=abc apikey=abcdef1",
                 "ſecret=abcdefg", "AKIA" + "A" * 15, "AKIA" + "A" * 16 + "b", "AKIAkAKIA" + "B" * 20,
                 "f" * 23, "é" + "f" * 24 + "G" + "a0" * 15, "passwd=" + "x" * 5 + " tokenfoo"):
        got = [f"{s['kind']}:{s['start']}:{s['end']}" for s in S.spans_of(text) if s["kind"] in S.BASE_KINDS]
        assert got == plain_spans(text), text


def test_query_against_plain_patterns(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = contract.queries()["op5_secret_scan"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert r.n_assign == sum(s.startswith("assign") for s in spans)
        assert set(spans) <= set(r.spans.split(","))  | {""}


def test_edges(spark):
    rows = S.scan(edge_docs(spark)).collect()
    assert len(rows) == len(edge_rows())
    assert all(r.spans == [] for r in rows if r.doc_id in (1, 2, 3, 5))
    assert S.scan(empty_docs(spark)).count() == 0
    frame = spark.createDataFrame([(1, "a token=abcdef0123456789abcdef0123 b", 99), (2, None, None), (3, "clean", 7)],
                                  "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in S.redact(frame).collect()}
    assert got == {1: ("a [SECRET] b", 12), 2: (None, None), 3: ("clean", 7)}
    assert S.redact(edge_docs(spark).select(COLUMNS)).columns == COLUMNS


def wrapped(data, width, end="\n"):
    body = b64(data)
    return end.join(body[i:i + width] for i in range(0, len(body), width))


OPENSSH = S.OPENSSH_MAGIC + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + b"\0\0\0\1" + b"".join(
    len(x).to_bytes(4, "big") + x for x in (SSH, b"p" * 130))


def test_escaped_line_ends():
    for end in ("\\n", "\\r\\n", "\\\\n", "\r\n", "\n  "):
        for data, kind in ((RSA, "der"), (PKCS8, "der"), (OPENSSH, "ssh")):
            block = f"-----BEGIN PRIVATE KEY-----{end}{wrapped(data, 64, end)}{end}-----END PRIVATE KEY-----"
            assert kinds(f'{{"private_key": "{block}{end}", "n": 1}}') == [(kind, block)], end
            body = wrapped(data, 64, end)
            assert kinds(f'KEY="{end}{body}{end}"') == [(kind, body)], end  # no armour
            assert kinds(f"{end}{body}{end}-----END PRIVATE KEY-----") == [(kind, body)], end


def test_wrapped_without_a_begin_line():
    for data, kind in ((RSA, "der"), (PKCS8, "der"), (SSH + b"\0\0\0\x40" + b"c" * 64, "ssh"), (OPENSSH, "ssh")):
        for width in (64, 76):
            body = wrapped(data, width)
            assert kinds(f"see\n{body}\nand more text") == [(kind, body)]
            assert kinds(f"{body}\n{body}\n") == [(kind, body)] * 2
    assert kinds("\n".join(PKCS8.hex()[i:i + 60] for i in range(0, len(PKCS8.hex()), 60)))[0][0] == "der"
    assert kinds(wrapped(RSA[:-3], 64)) == kinds(wrapped(RSA + b"zz", 64)) == []


def test_keys_inside_a_run():
    for data, kind in ((RSA, "der"), (PKCS8, "der"), (SSH, "ssh"), (OPENSSH, "ssh")):
        for before in ("n", "key/", "MIIE", "AAAA", "Zm9v"):
            assert kinds(f"x {before}{b64(data)} y") == [(kind, b64(data))], before
        assert (kind, data.hex()) in kinds(f"x f{data.hex()} y") and (kind, data.hex().upper()) in kinds(data.hex().upper())
    assert kinds(f"{b64(RSA).rstrip('=')}-----END KEY-----") == [("der", b64(RSA).rstrip("="))]


def test_signed_tokens_of_any_json_header():
    for head in ('{ "alg": "HS256"}', '{\n "alg": "HS256"}', ' {"alg":"HS256"}'):
        token = f"{b64(head.encode(), True).rstrip('=')}.{b64(b'{ }', True)}.{'s' * 20}"
        assert kinds(f"a {token} b") == [("jwt", token)]
        assert kinds(f"a authorization.bearer.{token} b") == [("jwt", token)]


def test_many_prefixes_take_linear_time():
    for text in ("MIIE" * 100_000, "AAAAB3NzaC1yc2" * 30_000, "b3BlbnNzaC1rZXktdjEA" * 20_000, "3082" * 100_000, "MA\n" * 100_000):
        assert kinds(text) == [] or text[0] == "b"


def b64url(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def kinds_in(text):
    return [(s["kind"], text[s["start"]:s["end"]]) for s in S.spans_of(text) if s["kind"] not in S.BASE_KINDS]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\\n"])
def test_encrypted_pem_blocks(end):
    body = base64.b64encode(bytes(range(7, 7 + 96))).decode()
    lines = ["-----BEGIN RSA PRIVATE KEY-----", "Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC," + "0A" * 16, "", body[:64], body[64:],
             "-----END RSA PRIVATE KEY-----"]
    block = end.join(lines)
    assert kinds_in(f"key: {block} end") == [("pem", block)]
    for wrong in (block.replace("4,ENCRYPTED", "4,MIC-ONLY"), block.replace(",0A", ","), block.replace(body[64:], body[64:-4]),
                  block.replace("DEK-Info", "Other")):
        assert kinds_in(wrong) == []


def pgp_block(packets, end="\n"):
    body = base64.b64encode(packets).decode()
    return end.join(["-----BEGIN PGP PRIVATE KEY BLOCK-----", "Version: 1", "", *[body[i:i + 64] for i in range(0, len(body), 64)], "=aB3d",
                     "-----END PGP PRIVATE KEY BLOCK-----"])


def test_openpgp_private_key_blocks():
    secret = b"\4" + bytes(299)
    packets = b"\x95" + len(secret).to_bytes(2, "big") + secret + b"\xcd\x05a@b.c"  # old and new lengths
    block = pgp_block(packets)
    assert kinds_in(f"x {block} y") == [("pgp", block)]
    long = bytes([0xC5, 255]) + (500).to_bytes(4, "big") + b"\4" + bytes(499)
    two = bytes([0xC5, 192, 8]) + b"\6" + bytes(199)
    assert all(kinds_in(pgp_block(p))[0][0] == "pgp" for p in (long, two))
    for wrong in (packets[:-1], b"\xcd\x05a@b.c" + packets, b"\x95\0\x05" + b"\2abcd", b"", bytes([0xC5, 230]) + bytes(300)):
        assert kinds_in(pgp_block(wrong)) == []


def test_tokens_of_five_parts_and_behind_an_underscore():
    signed = ".".join([b64url(b'{"alg":"HS256","typ":"JWT"}'), b64url(b'{"sub":"123456"}'), b64url(bytes(32))])
    five = ".".join([b64url(b'{"alg":"RSA-OAEP","enc":"A256GCM"}'), b64url(bytes(range(64))), b64url(bytes(12)), b64url(bytes(40)), b64url(bytes(16))])
    direct = ".".join([b64url(b'{"alg":"dir","enc":"A128GCM"}'), "", b64url(bytes(12)), b64url(bytes(40)), b64url(bytes(16))])
    for token in (signed, five, direct):
        assert kinds_in(f"see {token} here") == [("jwt", token)]
        assert kinds_in(f"id_{token}") == [("jwt", token)] and kinds_in(f"a-b_{token}") == [("jwt", token)]
        assert kinds_in("x" + token) == []
    assert kinds_in(five.replace(b64url(b'{"alg":"RSA-OAEP","enc":"A256GCM"}'), b64url(b'{"alg":"RSA-OAEP","zip":"A256GCM"}'))) == []


def test_redact_with_any_columns(spark):
    signed = ".".join([b64url(b'{"alg":"none"}'), b64url(b'{"a":1}'), b64url(bytes(20))])
    df = spark.createDataFrame([(1, f"t {signed}", 2), (2, None, 3), (3, "plain", 4)], "doc_id long, text string, `a.b` int")
    got = sorted(tuple(r) for r in S.redact(df).collect())
    assert got == [(1, "t [SECRET]", 2), (2, None, 3), (3, "plain", 4)] and S.redact(df).columns == df.columns
