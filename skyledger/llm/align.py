"""Cross-tokenizer alignment by hash-set intersection of token ends.

Two tokenizers A and B cut the same bytes into tokens. The cumulative ends of each side's
tokens go into a dictionary from end to index; the sorted keys that both dictionaries have
are the byte offsets where tokens of both sides end, and they slice both id lists into
groups. Every slice has one link, between its last A and its last B token, whose byte ranges
end together (tokens have at least one byte, so no other pair of the slice does).

A very long text is cut into slices where a character that is not white space is followed
by a space or a line end. A cuts there always; B does unless a piece of its vocabulary
reaches over such a place, in which case texts are aligned whole. So a slice has the same
tokens by itself, and its groups are its own.

Corpus counts: a link is coded as one integer a * |B| + b. Every document's codes are written
with it; counts per code are a partial and a final aggregate. Of two tokens that end together
the shorter is a suffix of the longer, so there are at most as many codes as suffixes of
tokens in the other vocabulary (``most_pairs``, some 300,000 for the given files, whatever
the corpus), and the counts are broadcast to the documents' links; if there are ever more
of them than the bound, they meet by a shuffle.

Defined results: texts that are null, empty, or not given back by A or B have zeros and an
empty string; a null doc_id stays null; repeated rows come back once each; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.registry import register, table
from skyledger.llm.tokens import byte_letters
from skyledger.session import ship_package, stage_table

#: Fixed value: the pre-token pattern of byte-level files that name none.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CUT = re.compile(r"(?<=\S)(?=[ \n])")
SLICE_CHARS = 1 << 20
WORD_START = "▁"  # a space, in B's pieces


class ByteTokens:
    """Side A: ids of a byte-level tokenizer file; ``table[i]`` has the bytes of id i. A file whose ids
    are the ranks of its merges is run as such, which gives the same ids several times faster."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {c: b for b, c in enumerate(byte_letters())}
        self.table = [b""] * self.tok.get_vocab_size()
        for token, i in self.tok.get_vocab().items():
            self.table[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.fast = None
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        vocab = model.get("vocab") or {}
        merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges") or []]
        ranked = (model.get("type") == "BPE" and not spec.get("normalizer") and not model.get("ignore_merges")
                  and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                  and len(vocab) == 256 + len(merges)
                  and all(vocab.get(m.replace(" ", "")) == i for i, m in enumerate(merges, 256)))
        if ranked:
            import tiktoken

            self.fast = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, special_tokens={},
                                          mergeable_ranks={self.table[i]: i for i in vocab.values()})

    def ids(self, text: str) -> list[int]:
        if self.fast:
            return self.fast.encode_ordinary(text)
        return self.tok.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """Side B: ids of a sentence-piece model, which puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.tok = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.tok.id_to_piece(i) for i in range(self.tok.get_piece_size())]
        self.table = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p)
                      else p.replace(WORD_START, " ").encode() for p in pieces]
        self.by_slice = (len(self.tok.encode("a")) == 1
                         and not any(re.search(rf"[^\s{WORD_START}][{WORD_START}\n]", p) for p in pieces))

    def ids(self, text: str) -> list[int]:
        """``text`` begins with the space that the model adds, or, cut from a text, with white space."""
        if text[0] == " " and len(text) > 1:
            return self.tok.encode(text[1:])
        return self.tok.encode("a" + text)[1:]


def align(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The counts of A tokens and of B tokens up to each byte offset where tokens of both end."""
    at_a = dict(zip(ends_a, range(1, len(ends_a) + 1), strict=True))
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1), strict=True))
    common = sorted(at_a.keys() & at_b.keys())
    return (np.fromiter(map(at_a.__getitem__, common), np.int64, len(common)),
            np.fromiter(map(at_b.__getitem__, common), np.int64, len(common)))


class Aligner:
    """Alignments of texts: (n_a, n_b, link codes, groups as text)."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self.size_a, self.size_b = (np.array([len(t) for t in side.table]) for side in (self.a, self.b))
        names = [[np.array([f"{i}{mark}" for i in range(len(side.table))], dtype=object) for mark in marks]
                 for side, marks in ((self.a, ",|"), (self.b, ",;"))]
        (self.inner_a, self.last_a), (self.inner_b, self.last_b) = names
        self.code = np.int32 if len(self.a.table) * len(self.b.table) < 1 << 31 else np.int64

    def _slice(self, text: str):
        """The alignment of a slice, or None if the tokens do not give it back."""
        raw, ids_a, ids_b = text.encode(), self.a.ids(text), self.b.ids(text)
        if (b"".join(map(self.a.table.__getitem__, ids_a)) != raw
                or b"".join(map(self.b.table.__getitem__, ids_b)) != raw):
            return None
        a, b = np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)
        to_a, to_b = align(np.cumsum(self.size_a[a]).tolist(), np.cumsum(self.size_b[b]).tolist())
        n_a, n_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        codes = (a[to_a - 1] * len(self.b.table) + b[to_b - 1]).astype(self.code)
        names_a, names_b = self.inner_a[a], self.inner_b[b]
        names_a[to_a - 1], names_b[to_b - 1] = self.last_a[a[to_a - 1]], self.last_b[b[to_b - 1]]
        text = np.empty(len(a) + len(b), dtype=object)  # a group's B tokens come behind its A tokens
        text[np.arange(len(a)) + np.repeat(to_b - n_b, n_a)] = names_a
        text[np.arange(len(b)) + np.repeat(to_a, n_b)] = names_b
        return len(a), len(b), codes, "".join(text.tolist())[:-1]

    def text(self, text: str | None):
        none = (0, 0, np.zeros(0, self.code), "")
        if not text:
            return none
        whole, parts, at = " " + text, [], 0
        while at < len(whole):
            m = CUT.search(whole, at + SLICE_CHARS) if self.b.by_slice and len(whole) - at > SLICE_CHARS else None
            end = m.start() if m else len(whole)
            parts.append(self._slice(whole[at:end]))
            if parts[-1] is None:
                return none
            at = end
        return (sum(p[0] for p in parts), sum(p[1] for p in parts), np.concatenate([p[2] for p in parts]),
                ";".join([p[3] for p in parts]))


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def most_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many pairs of tokens can end together: suffixes of the tokens of one side in the other."""
    def suffixes(tokens, others, first):
        others = set(others)
        return sum(t[i:] in others for t in set(tokens) for i in range(first, len(t)))

    return suffixes(a, b, 0) + suffixes(b, a, 1)


def align_documents(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256, and the ``groups`` text if asked for."""
    ship_package(docs.sparkSession)
    sides = ByteTokens(path_a), PieceTokens(path_b)
    small = len(sides[0].table) * len(sides[1].table) < 1 << 31
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "links", "groups_sha256", "groups"]
    kinds = [*[pa.int64()] * 5, pa.list_(pa.int32() if small else pa.int64()), pa.string(), pa.string()]
    schema = ("row long, doc_id long, n_a long, n_b long, n_groups long, "
              f"links array<{'int' if small else 'long'}>, groups_sha256 string, groups string")
    if not with_groups:
        names, kinds, schema = names[:-1], kinds[:-1], schema.removesuffix(", groups string")

    def run(batches):
        found = aligner(path_a, path_b)
        for batch in batches:
            n_a, n_b, codes, hashes, kept = [], [], [np.zeros(0, found.code)], [], []
            for text in batch.column(2):
                a, b, code, groups = found.text(text.as_py())
                n_a.append(a)
                n_b.append(b)
                codes.append(code)
                hashes.append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
                if with_groups:
                    kept.append(groups)
            n = np.array([len(c) for c in codes])
            links = pa.ListArray.from_arrays(pa.array(np.cumsum(n), pa.int32()), pa.array(np.concatenate(codes)))
            columns = [batch.column(0), batch.column(1), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()),
                       pa.array(n[1:], pa.int64()), links, pa.array(hashes, pa.string()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds)], names)  # noqa: B905

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    aligned = stage_table(rows.mapInArrow(run, schema), "aligned")
    link = F.explode("links").alias("link")
    pairs = aligned.select(link).groupBy("link").agg(F.count("*").alias("n"))
    highest = F.max("n").over(Window.partitionBy(F.pmod("link", F.lit(len(sides[1].table)))))
    counts = stage_table(pairs.select("link", "n", (F.col("n") == highest).cast("long").alias("best")), "align_counts")
    if counts.count() <= most_pairs(*(s.table for s in sides)):
        counts = F.broadcast(counts)  # never more, unless a tokenizer file breaks the rule
    scored = (aligned.select("row", link).join(counts, "link").groupBy("row")
              .agg(F.sum("best").alias("n_best"), F.sum("n").alias("count_sum")))
    zero = F.lit(0).cast("long")
    out = ["doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
           F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"]
    return (aligned.drop("links").join(scored, "row", "left")
            .select(*out, *(["groups"] if with_groups else [])))


def tokenizer_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@register("op11_alignment")
def op11_alignment(spark, sf_dir):
    return align_documents(table(spark, sf_dir, "documents"), *tokenizer_files())
