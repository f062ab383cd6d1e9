"""Language identification with hyperdimensional profiles.

Every letter (lower case; one shared symbol for anything that is not a letter) has a
random vector of +1 and -1, generated from its code point. A trigram around a letter is
bound as ``rotate(rotate(a) * b) * c`` = rotate²(a) * rotate(b) * c, and a text's vector
is the sum (bundle) of its trigram vectors. The prototype of a language is the bundle of
all its training texts. The prediction is the prototype of highest cosine, ties to the
smaller name; ``score`` is that cosine, at least 0.

Bundles are sums of integers, so they do not depend on how rows are dealt. Training sums
one vector per language and task and then adds them per component; only the prototypes
(languages x dimensions) reach the driver. ``max_languages`` bounds them; more names than
that are an error, not a cut.

``keep_identified`` judges a text of ``JUDGED_CHARS`` characters by the mean cosine of its
trigrams with a prototype, which does not depend on how many trigrams it has. ``floors``
has the lowest such mean of a language's training texts, each against the bundle of the
others; a language of many letters spreads its trigrams, so genuine texts lie low.

Defined results: ``und`` with score 0 for a null text, a text without a letter, or when
nothing was learned; a null doc_id counts as an empty text in the split, so it is held
out; rows with a null lang or text teach nothing; repeated rows teach repeatedly; whole
texts count, in segments; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.registry import register, table
from skyledger.llm.workers import give_back
from skyledger.session import ship_package

DIMENSIONS = 1024
SEED = 7
MAX_LANGUAGES = 1000
BLOCK_CHARS, BLOCK_TEXTS = 1 << 19, 128
CELLS = 1 << 21  # of one count matrix
TRIGRAMS = 2048  # bound at a time
UNDETERMINED = "und"
JUDGED_CHARS = 200  # texts of so many characters are held against chance


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Code point -> code point of its lower-case letter, 0 for anything else."""
    fold = np.zeros(0x110000, dtype=np.int32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            fold[cp] = ord(low) if len(low) == 1 else cp
    return fold


@lru_cache(maxsize=4096)
def letter_vector(cp: int, dimensions: int) -> np.ndarray:
    bits = np.random.Generator(np.random.Philox(key=[SEED, cp])).integers(0, 2, dimensions, dtype=np.int8)
    return 2 * bits - 1


def _blocks(texts):
    """Lists of (text position, segment) with about BLOCK_CHARS characters; a segment carries one
    character of context on either side, which is not a trigram's centre there."""
    block, chars = [], 0
    for k, text in enumerate(texts):
        for at in range(0, len(text or ""), BLOCK_CHARS):
            end = min(at + BLOCK_CHARS, len(text))
            segment = (text[at - 1] if at else " ") + text[at:end] + (text[end] if end < len(text) else " ")
            block.append((k, segment))
            chars += len(segment)
            if chars >= BLOCK_CHARS or len(block) >= BLOCK_TEXTS:
                yield block
                block, chars = [], 0
    if block:
        yield block


def bundles(texts, groups, n_groups: int, dimensions: int) -> np.ndarray:
    """Sum of trigram vectors (n_groups x dimensions) of the texts of each group; ``groups`` has
    the group of every text."""
    out = np.zeros((n_groups, dimensions))
    fold = letter_table()
    for block in _blocks(texts):
        codes = fold[np.frombuffer("".join(s for _, s in block).encode("utf-32-le"), dtype=np.uint32)]
        sizes = np.array([len(s) for _, s in block])
        ends = np.cumsum(sizes)
        centre = codes != 0
        centre[ends - 1] = False
        centre[ends - sizes] = False
        at = np.nonzero(centre)[0]
        if not len(at):
            continue
        used, group = np.unique(np.array([groups[k] for k, _ in block]), return_inverse=True)
        letters, code = _compact(codes)
        k = len(letters)
        trigram = (code[at - 1] * k + code[at]) * k + code[at + 1]
        distinct, trigram = _compact(trigram, k ** 3)
        owner = np.repeat(group, sizes)[at]
        vectors = [np.stack([np.roll(letter_vector(int(c), dimensions), r) for c in letters]) for r in (2, 1, 0)]
        step = max(1, CELLS // len(distinct))
        for first in range(0, len(used), step):
            mine = (owner >= first) & (owner < first + step) if len(used) > step else slice(None)
            rows = min(step, len(used) - first)
            counts = np.bincount((owner[mine] - first) * len(distinct) + trigram[mine],
                                 minlength=rows * len(distinct)).reshape(rows, -1).astype(np.float32)
            for t in range(0, len(distinct), TRIGRAMS):
                d = distinct[t:t + TRIGRAMS]
                bound = vectors[0][d // (k * k)] * vectors[1][d // k % k] * vectors[2][d % k]
                out[used[first:first + rows]] += counts[:, t:t + TRIGRAMS] @ bound.astype(np.float32)
    return out


def _compact(values: np.ndarray, top: int = 0x110000):
    """Distinct values in order, and every value's position among them."""
    if top > 1 << 23:
        return np.unique(values, return_inverse=True)
    there = np.zeros(top, dtype=bool)
    there[values] = True
    distinct = np.nonzero(there)[0]
    place = np.zeros(top, dtype=np.int64)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[values]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learn(labelled: DataFrame, dimensions: int = DIMENSIONS,
          max_languages: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """Language names in order and the bundles of their training texts from rows (text, lang)."""
    ship_package(labelled.sparkSession)

    def rows(sums):
        for lang in sorted(sums):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(range(dimensions), pa.int32()),
                 pa.array(np.rint(sums[lang]).astype(np.int64))], ["lang", "dim", "value"])

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = (t.as_py() for t in batch.column(0)), batch.column(1).to_pylist()
            names = sorted(set(langs))
            place = {n: i for i, n in enumerate(names)}
            for n, vector in zip(names, bundles(texts, [place[x] for x in langs], len(names), dimensions),
                                 strict=True):
                sums[n] = sums.get(n, 0) + vector
            if len(sums) > max_languages:
                yield from rows(sums)
                sums = {}
        yield from rows(sums)

    parts = (labelled.select("text", "lang").filter("text is not null and lang is not null")
             .mapInArrow(run, "lang string, dim int, value long"))
    whole = (parts.groupBy("lang", "dim").agg(F.sum("value").alias("value")).groupBy("lang")
             .agg(F.array_sort(F.collect_list(F.struct("dim", "value")))["value"].alias("bundle")))
    learned = sorted((r.lang, r.bundle) for r in whole.limit(max_languages + 1).collect())
    if len(learned) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages if this is meant")
    learned = [(name, bundle) for name, bundle in learned if any(bundle)]
    return [name for name, _ in learned], np.array([b for _, b in learned], np.float64).reshape(-1, dimensions)


def unit_rows(sums: np.ndarray) -> np.ndarray:
    return sums / np.linalg.norm(sums, axis=1, keepdims=True)


def train(labelled: DataFrame, dimensions: int = DIMENSIONS,
          max_languages: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """Language names in order and their prototypes (unit rows) from rows (text, lang)."""
    names, sums = learn(labelled, dimensions, max_languages)
    return names, unit_rows(sums)


def floors(labelled: DataFrame, names: list[str], sums: np.ndarray) -> np.ndarray:
    """For each learned language the lowest mean trigram cosine of a training text of
    ``JUDGED_CHARS`` characters with the bundle of the language's other texts; NaN with fewer than
    two such texts."""
    ship_package(labelled.sparkSession)
    place, dimensions = {n: i for i, n in enumerate(names)}, sums.shape[1]

    def run(batches):
        count, least = np.zeros(len(names), dtype=np.int64), np.full(len(names), np.inf)
        for batch in batches:
            for first in range(0, len(batch), BLOCK_TEXTS):
                texts = [t.as_py() for t in batch.column(0).slice(first, BLOCK_TEXTS)]
                langs = np.array([place[n] for n in batch.column(1).slice(first, BLOCK_TEXTS).to_pylist()])
                vectors = bundles(texts, range(len(texts)), len(texts), dimensions)
                rest = sums[langs] - vectors
                size = np.linalg.norm(rest, axis=1) * np.array([letters(t) for t in texts]) * dimensions ** 0.5
                some = size > 0
                mean = (vectors * rest).sum(axis=1)[some] / size[some]
                np.add.at(count, langs[some], 1)
                np.minimum.at(least, langs[some], mean)
        for i in np.nonzero(count)[0].tolist():
            yield pa.RecordBatch.from_pydict({"lang": [names[i]], "n": [int(count[i])], "least": [float(least[i])]})

    parts = (labelled.select("text", "lang").filter(F.col("lang").isin(names) & (F.length("text") >= JUDGED_CHARS))
             .mapInArrow(run, "lang string, n long, least double"))
    out = np.full(len(names), np.nan)
    for r in parts.groupBy("lang").agg(F.sum("n").alias("n"), F.min("least").alias("least")).collect():
        if r.n > 1:
            out[place[r.lang]] = r.least
    return out


def _cosines(texts: pa.Array, prototypes: np.ndarray):
    """Blocks of texts: the texts, the lengths of their vectors, and their cosines with the prototypes."""
    for first in range(0, len(texts), BLOCK_TEXTS):
        some = [t.as_py() for t in texts.slice(first, BLOCK_TEXTS)]
        vectors = bundles(some, range(len(some)), len(some), prototypes.shape[1])
        size = np.linalg.norm(vectors, axis=1)
        yield some, size, vectors @ prototypes.T / np.maximum(size, 1e-12)[:, None]


def predictor(names: list[str], prototypes: np.ndarray):
    """A function from a text column to struct(lang, score)."""
    @F.arrow_udf("struct<lang:string,score:double>")
    def identify(texts: pa.Array) -> pa.Array:
        lang, score = [], []
        for some, size, cosine in _cosines(texts, prototypes):
            if not names:
                lang += [UNDETERMINED] * len(some)
                score += [0.0] * len(some)
                continue
            best = cosine.argmax(axis=1)
            lang += [names[b] if n or has_letter(t) else UNDETERMINED
                     for b, n, t in zip(best.tolist(), size.tolist(), some, strict=True)]
            score += np.clip(cosine[np.arange(len(some)), best], 0.0, 1.0).tolist()
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                          ["lang", "score"])

    return identify


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def letters(text: str) -> int:
    """Number of letters, which is the number of trigrams."""
    return sum(int(np.count_nonzero(letter_table()[np.frombuffer(text[at:at + BLOCK_CHARS].encode("utf-32-le"), np.uint32)]))
               for at in range(0, len(text), BLOCK_CHARS))


def identify(docs: DataFrame, names: list[str], prototypes: np.ndarray) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    found = predictor(names, prototypes)(F.col("text"))
    return (docs.select("doc_id", found.alias("found"))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                    F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")))


def keep_identified(docs: DataFrame, names: list[str], prototypes: np.ndarray,
                    lowest: np.ndarray | None = None, judged_chars: int = JUDGED_CHARS) -> DataFrame:
    """Rows of ``docs`` written in a learned language. A text is rejected if it has no letter, or if
    it has ``judged_chars`` characters, its best cosine is one that a random vector reaches (three
    standard deviations) and no language in ``lowest`` (``floors``) has training texts as low: its
    cosine lies by three standard deviations below that of the lowest one, at the trigram count of
    this text, for every language. A shorter text shows too little to be judged and stays, and where
    nothing was learned nothing can be judged: every text with a letter stays."""
    dimensions = prototypes.shape[1]
    chance = 3 / dimensions ** 0.5
    lowest = np.full(len(names), np.nan) if lowest is None else lowest

    @F.arrow_udf("boolean")
    def spoken(texts: pa.Array) -> pa.Array:
        out = []
        for some, size, cosine in _cosines(texts, prototypes):
            for t, n, row in zip(some, size.tolist(), cosine, strict=True):
                if not (n or has_letter(t)):
                    out.append(False)
                elif not len(row) or len(t) < judged_chars or row.max() > chance:
                    out.append(True)
                else:
                    usual = lowest * (letters(t) * dimensions ** 0.5 / max(n, 1e-12))
                    out.append(bool((row > usual - chance).any()))  # never by NaN
        give_back()
        return pa.array(out, pa.bool_())

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return (docs.select(row.alias("row"), spoken(F.col("text")).alias("spoken"))
            .filter("spoken").select("row.*"))


def train_split(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(F.col("doc_id"))).select("text", "lang")


@register("op2_language_id")
def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return identify(docs, *train(train_split(docs)))
