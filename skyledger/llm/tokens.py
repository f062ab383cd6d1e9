"""Token ids of a public tokenizer file, with an exact word-level memory.

``WordBpe`` covers files whose pre-tokenizer never joins text across white space
(BPE with word ends). Plain Latin texts are cut into words by one pattern, and the ids
of each word are remembered; any other text is split at ASCII white space, and a chunk
that is not plain goes through the whole tokenizer. A memory has two generations: a full
young one becomes the old one, and words met again move back, so frequent words stay
however many words there are. Files of another kind are encoded text by text.
"""

from __future__ import annotations

import json
import re
import sys
from array import array

#: The word pattern of the file kind that the fast path knows.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]

#: Printable ASCII and the Latin letters below U+0250: stable under NFC, one letter
#: to one letter in lower case (U+0130 is the exception and left out).
_PLAIN = re.compile(r"[ \t-\r!-~À-ÖØ-öø-įı-ɏ]+")
_WORDS = re.compile(r"[a-zß-öø-ɏ]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^ \t-\r0-9a-zß-öø-ɏ]+")
_SPACE = re.compile(rb"[ \t-\r]")

MEMORY_ENTRIES = 150_000  # of one generation, at about 160 bytes
KEEP_BYTES = 40
SLICE_BYTES = 1 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out, extra = [], 256
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class Memory(dict):
    """Values of ``compute``, kept in two generations of ``MEMORY_ENTRIES``; long keys are not kept."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.old = compute, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.compute(key)
            if len(key) > KEEP_BYTES:
                return value
        if len(self) >= MEMORY_ENTRIES:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def forget(self):
        self.clear()
        self.old = {}


class WordBpe:
    """``ids(raw)``: little-endian unsigned 32-bit ids of UTF-8 bytes, as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        norm = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.by_word = (norm == WORD_NORMALIZERS
                        and pre[0].get("pattern", {}).get("Regex") == WORD_PATTERN
                        and [p.get("type") for p in pre] == ["Split", "ByteLevel"])
        self.letters = byte_letters()
        self.words = Memory(self._word)
        self.chunks = Memory(self._chunk)

    @staticmethod
    def _pack(ids) -> bytes:
        a = array("I", ids)
        if sys.byteorder != "little":
            a.byteswap()
        return a.tobytes()

    def _word(self, word: str) -> bytes:
        mapped = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
        return self._pack([t.id for t in self.tok.model.tokenize(mapped)])

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, _WORDS.findall(text.lower())))

    def _chunk(self, raw: bytes) -> bytes:
        text = raw.decode()
        if "<|" not in text and _PLAIN.fullmatch(text):
            return self._plain(text)
        return self._pack(self.tok.encode(text, add_special_tokens=False).ids)

    def _slice(self, raw: bytes) -> bytes:
        text = raw.decode()
        if "<|" not in text and _PLAIN.fullmatch(text):
            return self._plain(text)
        return b"".join(map(self.chunks.__getitem__, raw.split()))

    def ids(self, raw: bytes) -> bytes:
        if not self.by_word:
            return self._pack(self.tok.encode(raw.decode(), add_special_tokens=False).ids)
        if len(raw) <= SLICE_BYTES:
            return self._slice(raw)
        out, at = [], 0
        while at < len(raw):  # a very long text goes in slices that end at white space
            m = _SPACE.search(raw, at + SLICE_BYTES)
            end = m.start() if m else len(raw)
            out.append(self._slice(raw[at:end]))
            at = end
        return b"".join(out)

    def forget(self):
        """Frees the memories; the tokenizer stays loaded."""
        self.words.forget()
        self.chunks.forget()


_LOADED: dict[str, WordBpe] = {}


def tokenizer(path: str) -> WordBpe:
    """The tokenizer of a file, loaded once per worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]
