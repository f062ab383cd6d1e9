"""Secret scan with structural confirmation.

Base kinds are patterns: ``assign`` (a named credential and its value), ``access``
(access key ids) and ``hex`` (long hexadecimal runs). The method adds spans whose
decoded content has the structure of key material, so chance runs of letters are
not reported:

* ``der``      base64 or hex that decodes to one ASN.1 SEQUENCE whose nested lengths
               fill it exactly and whose children are those of a key
* ``ssh``      base64 or hex of length-prefixed fields with a key algorithm first, or
               an OpenSSH private key container
* ``jwt``      three base64url parts; the first decodes to a JSON object with ``alg``,
               the second to a JSON object; or five parts whose first has ``alg`` and
               ``enc`` (an encrypted token)
* ``pem``      an armoured block whose headers say that it is encrypted, with a whole number
               of cipher blocks
* ``pgp``      an armoured OpenPGP private key: packets that fill it exactly, a secret key first

An armoured block (BEGIN ... KEY / END) counts as one candidate, its body joined over
line ends, real or escaped (``\\n`` and ``\\r\\n`` in a JSON or env string). A token may also
begin behind a hyphen or underscore of a longer word. Other candidates are
runs of base64 or hex, joined over line ends in the same way. A structure may begin anywhere
in a run, at one of the few prefixes its first bytes can have; its own lengths say where it
ends, and that must be the end of a line or of the run. A structure inside a confirmed one
is not reported again. Offsets are code points, end exclusive; spans are ordered by start, then
kind in the order of ``KINDS``.

Defined results: null and empty texts have no spans; whole texts are scanned whatever
their length; repeated rows are scanned once each; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.registry import register, table
from skyledger.llm.workers import give_back
from skyledger.session import ship_package

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("der", "ssh", "jwt", "pem", "pgp")

#: The base patterns. Letters of the credential names match in either case.
_NAMES = ("password", "passwd", "secret", "token", "api_?key")
_EITHER = "|".join(re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", n) for n in _NAMES)
ASSIGN = re.compile(rf"""(?:{_EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs: a shorter run is no match
MIN_ASSIGN, MIN_ACCESS = 6, 20

ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]*)KEY-----((?:[A-Za-z0-9+/=\s]++|\\++[rn])++)-----END \1KEY-----")
LINE_END = r"[ \t]*+(?:\r?\n|\r|(?:\\++r)?\\++n)[ \t]*+"
ESCAPED = re.compile(r"\\+[rn]|\s")
PADDING = re.compile("={0,2}")
MIN_RUN = 24
HEADED = re.compile(rf"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY( BLOCK|)-----{LINE_END}((?:[A-Za-z-]++:[^\r\n\\]*+{LINE_END})*+)"
                    r"((?:[A-Za-z0-9+/=\s]++|\\++[rn])++)-----END \1PRIVATE KEY\2-----")
HEADER = re.compile(r"([A-Za-z-]++): *([^\r\n\\]*)")
CHECKSUM = re.compile("=[A-Za-z0-9+/]{4}$")
SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]{10,}+)\.([A-Za-z0-9_-]{4,}+)\.([A-Za-z0-9_-]{10,}+))")
ENCRYPTED = re.compile(r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]{10,}+)\.([A-Za-z0-9_-]*+)\.([A-Za-z0-9_-]{4,}+)"
                       r"\.([A-Za-z0-9_-]*+)\.([A-Za-z0-9_-]{10,}+))")
OBJECT = re.compile("(?<=[_-])e[w-z0-3]")  # how an encoded brace begins, within a word

KEY_ALGORITHMS = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256",
                  b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")
OPENSSH_MAGIC = b"openssh-key-v1\0"
MAX_DEPTH = 12

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


# ------------------------------------------------------------- structures
def der_items(data: bytes, depth: int = 0) -> list | None:
    """The (tag, content or children) items that fill ``data`` exactly, or None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, n = data[at], data[at + 1]
        at += 2
        if n & 0x80:
            width = n & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            n = int.from_bytes(data[at:at + width], "big")
            at += width
        if at + n > len(data):
            return None
        content = data[at:at + n]
        at += n
        if tag & 0x20:
            content = der_items(content, depth + 1) if depth < MAX_DEPTH else None
            if content is None:
                return None
        items.append((tag, content))
    return items


def is_der_key(data: bytes) -> bool:
    """One SEQUENCE with the children of a private or public key."""
    if len(data) < 16 or data[0] != 0x30:
        return False
    top = der_items(data)
    if not top or len(top) != 1:
        return False
    children = top[0][1]
    tags = [tag for tag, _ in children]
    version = tags[:1] == [0x02] and len(children[0][1]) == 1
    algorithm = next((c for tag, c in children[:2] if tag == 0x30), None)
    named = bool(algorithm) and algorithm[0][0] == 0x06
    return (tags == [0x02] * 9 or tags[:6] == [0x02] * 6 and len(tags) == 6 and version  # RSA, DSA
            or version and tags[1:2] == [0x04] and set(tags[2:]) <= {0xA0, 0xA1}  # EC
            or version and tags[1:3] == [0x30, 0x04] and named  # PKCS 8
            or tags in ([0x30, 0x03], [0x30, 0x04]) and named  # public, encrypted
            or tags == [0x02, 0x02] and len(children[0][1]) >= 32)  # RSA public


def length_fields(data: bytes) -> list[bytes] | None:
    """32-bit length-prefixed fields that fill ``data`` exactly, or None."""
    fields, at = [], 0
    while at < len(data):
        if at + 4 > len(data):
            return None
        n = int.from_bytes(data[at:at + 4], "big")
        at += 4
        if at + n > len(data):
            return None
        fields.append(data[at:at + n])
        at += n
    return fields


def is_ssh_key(data: bytes) -> bool:
    if data.startswith(OPENSSH_MAGIC):
        body, at = data[len(OPENSSH_MAGIC):], 0
        for _ in range(3):  # cipher, kdf, kdf options
            if at + 4 > len(body):
                return False
            at += 4 + int.from_bytes(body[at:at + 4], "big")
        return at + 4 <= len(body) and 1 <= int.from_bytes(body[at:at + 4], "big") <= 16
    if data[:3] != b"\0\0\0":
        return False
    fields = length_fields(data)
    return bool(fields) and len(fields) >= 2 and fields[0] in KEY_ALGORITHMS


def is_encrypted_pem(headers: dict[str, str], data: bytes | None) -> bool:
    """Headers of an encrypted block: a cipher with its initial vector, and whole cipher blocks."""
    cipher, _, vector = headers.get("DEK-Info", "").partition(",")
    if headers.get("Proc-Type", "").replace(" ", "") != "4,ENCRYPTED" or not cipher or not data:
        return False
    return re.fullmatch("[0-9A-Fa-f]{16}|[0-9A-Fa-f]{32}", vector.strip()) is not None and len(data) % 8 == 0


def openpgp_packets(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of packets that fill ``data`` exactly, or None."""
    packets, at = [], 0
    while at < len(data):
        head, at = data[at], at + 1
        if not head & 0x80:
            return None
        if head & 0x40:  # new format
            tag, first = head & 0x3F, data[at] if at < len(data) else 224
            width = 1 if first < 192 else 2 if first < 224 else 5 if first == 255 else 0
            if not width or at + width > len(data):
                return None
            n = (first if width == 1 else (first - 192 << 8) + data[at + 1] + 192 if width == 2
                 else int.from_bytes(data[at + 1:at + 5], "big"))
        else:
            tag, width = head >> 2 & 0x0F, (1, 2, 4, 0)[head & 3]
            if not width or at + width > len(data):
                return None
            n = int.from_bytes(data[at:at + width], "big")
        at += width
        if at + n > len(data):
            return None
        packets.append((tag, data[at:at + n]))
        at += n
    return packets


def is_openpgp_key(data: bytes | None) -> bool:
    packets = openpgp_packets(data) if data else None
    return bool(packets) and packets[0][0] == 5 and packets[0][1][:1] in (b"\3", b"\4", b"\5", b"\6")


def unbase64(text: str) -> bytes | None:
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def structure(data: bytes | None) -> str | None:
    if data is None:
        return None
    return "der" if is_der_key(data) else "ssh" if is_ssh_key(data) else None


def _json_object(part: str) -> dict | None:
    data = unbase64(part)
    if not data or data.lstrip()[:1] != b"{":
        return None
    try:
        value = json.loads(data)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


# ------------------------------------------------------------------- runs
class Code:
    """Base64 or hex: its letters, the bytes they stand for, and the prefixes of key structures."""

    def __init__(self, letters: str, bits: int, der: str, encode, decode):
        self.bits, self.decode = bits, decode
        heads = [len(a).to_bytes(4, "big") + a for a in KEY_ALGORITHMS]
        fixed = [re.escape(encode(h)[:len(h) * 8 // bits]) for h in (*heads, OPENSSH_MAGIC)]
        self.prefix = re.compile("|".join([der, *fixed]), re.I if bits == 4 else 0)
        self.run = re.compile(f"[{letters}]++(?:{LINE_END}[{letters}]++)*+")

    def size(self, n: int) -> int:
        """Letters of ``n`` bytes."""
        return -(-n * 8 // self.bits)

    def bytes(self, letters: str, begin: int, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from byte ``at`` of what starts at letter ``begin``."""
        group = at // 3
        some = letters[begin + group * 24 // self.bits:begin + self.size(-(-(at + n) // 3) * 3)]
        if self.bits == 6 and len(some) % 4 == 1 or self.bits == 4 and len(some) % 2:
            some = some[:-1]
        return (self.decode(some) or b"")[at - 3 * group:][:n]


@lru_cache(maxsize=1)
def codes() -> tuple[Code, Code]:
    # 0x30 and a length: below 0x80, or 0x81 to 0x84 and so many bytes
    return (Code("A-Za-z0-9+/_-", 6, "M(?:[A-H]|I[E-T])", lambda b: base64.b64encode(b).decode(), unbase64),
            Code("0-9A-Fa-f", 4, "30(?:[0-7]|8[1-4])", bytes.hex, bytes.fromhex))


class Run:
    """A run of letters, joined over line ends. ``ends`` has the joined place after every piece."""

    def __init__(self, code: Code, match: re.Match):
        self.code, self.starts, self.ends, parts, at = code, [], [], [], 0
        begin = match.start()
        for k, piece in enumerate(re.split(f"({LINE_END})", match[0])):
            if k % 2 == 0:  # between line ends
                at += len(piece)
                parts.append(piece)
                self.starts.append(begin)
                self.ends.append(at)
            begin += len(piece)
        self.letters = "".join(parts)

    def place(self, at: int) -> int:
        """Where in the text the joined letter ``at`` is."""
        k = bisect_right(self.ends, at)
        return self.starts[k] + at - (self.ends[k - 1] if k else 0)

    def closes(self, begin: int, end: int) -> bool:
        """Whether a structure can end here: at the end of a piece, or, in the alphabet with + and /,
        before a hyphen or underscore."""
        if end > len(self.letters):
            return False
        k = bisect_left(self.ends, end)
        if self.ends[k] == end:
            return True
        return self.letters[end] in "-_" and not any(c in self.letters[begin:end] for c in "-_")

    def key_at(self, begin: int) -> tuple[str, int] | None:
        """Kind and end (joined) of the key that starts at joined letter ``begin``."""
        head = self.code.bytes(self.letters, begin, 0, 6)
        if head[:1] == b"\x30":
            return self._der(begin, head)
        if head[:3] == b"\0\0\0":
            return self._fields(begin)
        if self.code.bytes(self.letters, begin, 0, len(OPENSSH_MAGIC)) == OPENSSH_MAGIC:
            return self._container(begin)
        return None

    def _der(self, begin, head):
        if len(head) < 6:
            return None
        width = head[1] & 0x7F if head[1] & 0x80 else 0
        if width > 4 or head[1] == 0x80:
            return None
        n = 2 + width + (int.from_bytes(head[2:2 + width], "big") if width else head[1])
        end = begin + self.code.size(n)
        if end - begin < MIN_RUN or not self.closes(begin, end):
            return None
        data = self.code.decode(self.letters[begin:end])
        return ("der", end) if data and is_der_key(data) else None

    def _fields(self, begin):
        at, n_fields, found, most = 0, 0, None, (len(self.letters) - begin) * self.code.bits // 8
        while at + 4 <= most:
            at += 4 + int.from_bytes(self.code.bytes(self.letters, begin, at, 4), "big")
            if at > most:
                break
            n_fields += 1
            end = begin + self.code.size(at)
            if n_fields >= 2 and end - begin >= MIN_RUN and self.closes(begin, end):
                found = end
        if found is None or not is_ssh_key(self.code.decode(self.letters[begin:found]) or b""):
            return None
        return "ssh", found

    def _container(self, begin):
        """Up to the end of the piece in which the container's lengths end; if they do not end in
        the run, up to the end of the first piece."""
        most, at = (len(self.letters) - begin) * self.code.bits // 8, len(OPENSSH_MAGIC)

        def number():
            return int.from_bytes(self.code.bytes(self.letters, begin, at, 4), "big")

        for _ in range(3):  # cipher, kdf, kdf options
            if at + 4 > most:
                return None
            at += 4 + number()
        if at + 4 > most or not 1 <= number() <= 16:
            return None
        more, at = number() + 1, at + 4  # public keys, private part
        last = begin
        while more and at + 4 <= most:
            at, more = at + 4 + number(), more - 1
        if not more and at <= most:
            last = begin + self.code.size(at) - 1
        return "ssh", self.ends[bisect_right(self.ends, last)]


def run_spans(text: str, code: Code) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the keys in runs of a code; base64 with its padding."""
    out = []
    if not code.prefix.search(text):
        return out
    for m in code.run.finditer(text):
        if m.end() - m.start() < MIN_RUN:
            continue
        run, at = Run(code, m), 0
        while hit := code.prefix.search(run.letters, at):
            found = run.key_at(hit.start()) if len(run.letters) - hit.start() >= MIN_RUN else None
            at = hit.start() + 1
            if found:
                kind, at = found
                end = run.place(at - 1) + 1
                pad = PADDING.match(text, end) if code.bits == 6 else None
                out.append((run.place(hit.start()), pad.end() if pad else end, kind))
    return out


# ------------------------------------------------------------------ spans
def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of candidates whose decoded structure is confirmed."""
    out, armoured = [], []
    if "-----BEGIN " in text:
        for m in ARMOUR.finditer(text):
            kind = structure(unbase64(ESCAPED.sub("", m[2])))
            if kind:
                out.append((m.start(), KINDS.index(kind), m.end()))
                armoured.append((m.start(), m.end()))
        for m in HEADED.finditer(text):
            body, headers = ESCAPED.sub("", m[4]), dict(HEADER.findall(re.sub(LINE_END, "\n", m[3])))
            if m[2]:
                kind = "pgp" if is_openpgp_key(unbase64(CHECKSUM.sub("", body))) else None
            else:
                kind = "pem" if is_encrypted_pem(headers, unbase64(body)) else None
            if kind:
                out.append((m.start(), KINDS.index(kind), m.end()))
                armoured.append((m.start(), m.end()))

    def inside(start):
        return any(a <= start < b for a, b in armoured)

    for code in codes():
        out += [(a, KINDS.index(kind), b) for a, b, kind in run_spans(text, code) if not inside(a)]
    if "." in text:
        out += [(a, KINDS.index("jwt"), b) for a, b in token_spans(text)]
    return out


def _header(word: str) -> tuple[int, dict] | None:
    """Where the JSON object with ``alg`` that ends ``word`` begins, and the object."""
    for at in (0, *(m.start() for m in OBJECT.finditer(word))):
        head = _json_object(word[at:])
        if head is not None and isinstance(head.get("alg"), str):
            return at, head
    return None


def token_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of signed and encrypted tokens."""
    out = []
    for m in SIGNED.finditer(text):
        found = _header(m[1]) if _json_object(m[2]) is not None else None
        if found:
            out.append((m.start() + found[0], m.end(3)))
    if text.count(".") >= 4:
        for m in ENCRYPTED.finditer(text):
            found = _header(m[1])
            if found and isinstance(found[1].get("enc"), str) and all(unbase64(m[k]) is not None for k in range(2, 6)):
                out.append((m.start() + found[0], m.end(5)))
    return out


def spans_of(text: str) -> list[dict]:
    return [{"kind": KINDS[k], "start": s, "end": e}
            for s, k, e in sorted({*base_spans(text), *confirmed_spans(text)})]


def secret_spans(text: Column) -> Column:
    """All spans of a text column as an ordered array of (kind, start, end)."""
    @F.arrow_udf(SPANS)
    def find(texts: pa.Array) -> pa.Array:
        return pa.array([spans_of(t.as_py() or "") for t in texts], _ARROW)

    return find(text)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and its ``spans`` (``SPANS``), one row per document."""
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id"), secret_spans(F.col("text")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans as one) and n_chars
    renewed where the text changed, if there is such a column. All rows and columns stay."""
    ship_package(docs.sparkSession)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            text = t.as_py()
            parts, at = [], 0
            for span in spans_of(text or ""):
                if span["start"] >= at:
                    parts += [text[at:span["start"]], mark]
                at = max(at, span["end"])
            out.append("".join([*parts, text[at:]]) if parts else text)
        out = pa.array(out, pa.string())
        give_back()
        return out

    # one Python pass: the cleaned text is kept beside the old one in a struct
    both = docs.withColumn("text", F.struct(F.col("text").alias("old"), clean(F.col("text")).alias("new")))
    new = {"text": F.col("text.new")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("text.old").eqNullSafe(F.col("text.new")), F.col("n_chars")).otherwise(
            F.length("text.new").cast("long"))
    return both.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@register("op5_secret_scan")
def op5_secret_scan(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents"))
    spans = F.col("spans")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[count(k) for k in BASE_KINDS],
                        F.sha2(_digest(base), 256).alias("base_sha256"), _digest(spans).alias("spans"))
