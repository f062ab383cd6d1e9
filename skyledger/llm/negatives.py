"""Hard-negative mining with residue-number-system products.

For every anchor row the ``positives`` rows of its label with the highest scores are its
positives, and for every positive the ``negatives`` highest-scoring rows of another label
whose score lies in a window below the positive's score. Scores are inner products of
integer vectors, ties go to the smaller vec_id.

Products: both matrices are reduced modulo several primes below 256 (centred residues), and
multiplied in float32, which is exact as long as a slice of ``SLICE`` components is summed
before it is reduced again. The signed score is rebuilt from its residues by Chinese
remaindering (mixed-radix digits), with as many primes as the largest possible score needs.

Layout: rows are dealt by hash into blocks of about ``BLOCK_COMPONENTS`` components, and a
block travels once. Anchors are copied to every block they may meet: for positives the
blocks of their own label, for negatives all blocks. A block's rows come first in its
partition and are held; the anchors stream past in slices. A block keeps a few rows per
anchor (or anchor and positive), and windows limited per group before the shuffle merge them.
No group is held but a block, so a hot label or a group of copies only has more blocks.

Defined results: rows with a null id, label or vector, or with null or non-finite components
take no part; rows that agree in id, label and vector count once, and rows of one id that
differ are rows of their own (an anchor is never its own positive or negative); only vectors
of one dimension meet (empty ones score 0); components beyond 64 bits saturate and scores
wrap to 64 bits; an anchor without positives, or a positive with an empty window (a negative
score, say), gives no rows; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.registry import register, table
from skyledger.session import ship_package, stage_table

SLICE = 1024  # components; 1024 * 125 * 125 < 2**24, so float32 sums are exact
BLOCK_COMPONENTS = 1 << 21
SCORES = 1 << 20  # of one slice of anchors with a block
LEAST = np.iinfo(np.int64).min


def small_primes() -> list[int]:
    """The primes from 251 down."""
    return [p for p in range(251, 2, -1) if all(p % d for d in range(2, 16) if d < p)]


# --------------------------------------------------------------- products
def _residues(m: np.ndarray, p: int) -> np.ndarray:
    r = np.mod(m, p).astype(np.float32)
    r[r > p // 2] -= p
    return r


def _extent(m: np.ndarray) -> int:
    return max(int(m.max(initial=0)), -int(m.min(initial=0)))


class Block:
    """The rows of one block (integers, row by row), ready to be multiplied."""

    def __init__(self, rows: np.ndarray):
        self.rows, self.extent, self.reduced = rows, _extent(rows), {}

    def modulo(self, p: int) -> np.ndarray:
        if p not in self.reduced:
            self.reduced[p] = _residues(self.rows, p)
        return self.reduced[p]

    def scores(self, queries: np.ndarray) -> np.ndarray:
        """Exact inner products (int64, wrapped beyond it) of queries x rows."""
        need, primes, product = 2 * queries.shape[1] * _extent(queries) * self.extent + 1, [], 1
        for p in small_primes():
            if product > need:
                break
            primes.append(p)
            product *= p
        return chinese_remainder([self._modulo_product(queries, p) for p in primes], primes,
                                 (len(queries), len(self.rows)))

    def _modulo_product(self, queries: np.ndarray, p: int) -> np.ndarray:
        a, b = _residues(queries, p), self.modulo(p)
        total = None
        for at in range(0, a.shape[1], SLICE):
            part = a[:, at:at + SLICE] @ b[:, at:at + SLICE].T
            part -= p * np.rint(part / np.float32(p))
            total = part if total is None else total + part
        return np.mod(total, p).astype(np.int32) if total is not None else np.zeros((len(a), len(b)), np.int32)


def chinese_remainder(residues: list[np.ndarray], primes: list[int], shape) -> np.ndarray:
    """The signed numbers with these residues, between minus and plus half the primes' product."""
    digits: list[np.ndarray] = []
    for i, p in enumerate(primes):
        v = residues[i]
        for j in range(i):
            v = (v - digits[j]) * pow(primes[j], -1, p) % p
        digits.append(v)
    whole, half = 1, []
    for p in primes:
        whole *= p
    rest = whole // 2
    for p in primes:
        half.append(rest % p)
        rest //= p
    out, negative, equal = np.zeros(shape, np.uint64), np.zeros(shape, bool), np.ones(shape, bool)
    for v, h, p in reversed(list(zip(digits, half, primes, strict=True))):
        out = out * np.uint64(p) + v.astype(np.uint64)
        negative |= equal & (v > h)
        equal &= v == h
    out[negative] -= np.uint64(whole & 0xFFFFFFFFFFFFFFFF)
    return out.view(np.int64)


# ----------------------------------------------------------------- blocks
def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _meetings(batches, solve):
    """Partitions sorted by (cell, kind): for each cell its rows (kind 0), then slices of its anchors
    (kind 1); yields what ``solve`` makes of the cell's rows and a slice."""
    cell, held, block = None, [], None
    for batch in batches:
        if not len(batch):
            continue
        coded = batch.column("cell").dictionary_encode()
        code, kind = coded.indices.to_numpy(), batch.column("kind").to_numpy()
        edge = np.nonzero((code[1:] != code[:-1]) | (kind[1:] != kind[:-1]))[0] + 1
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(batch)], strict=True):
            part = batch.slice(a, b - a)
            name = part.column("cell")[0].as_py()
            if name != cell:
                cell, held, block = name, [], None
            if kind[a] == 0:
                held.append(part)
                continue
            if not held and block is None:
                continue
            if block is None:
                rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                dim, held = rows.column("dim")[0].as_py(), []
                order = np.lexsort((rows.column("mark").to_numpy(), rows.column("vec_id").to_numpy()))
                rows = rows.take(pa.array(order))
                block = rows.drop_columns(["vector"]), Block(_matrix(rows.column("vector"), dim)), dim
            step = max(1, SCORES // max(1, len(block[0])))
            for at in range(0, len(part), step):
                asked = part.slice(at, step)
                yield solve(block[0], asked, block[1].scores(_matrix(asked.column("vector"), block[2])))


def _first(scores: np.ndarray, k: int):
    """(row, column) of each row's k highest scores above LEAST, ties to the smaller column."""
    rows, columns, all_rows = [], [], np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        best = scores.argmax(axis=1)
        some = scores[all_rows, best] != LEAST
        rows.append(all_rows[some])
        columns.append(best[some])
        scores[all_rows, best] = LEAST
    return (np.concatenate([*rows, np.zeros(0, np.int64)]), np.concatenate([*columns, np.zeros(0, np.int64)]))


def _integers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _own(rows: pa.RecordBatch, asked: pa.RecordBatch) -> np.ndarray:
    return ((_integers(asked, "vec_id")[:, None] == _integers(rows, "vec_id"))
            & (_integers(asked, "mark")[:, None] == _integers(rows, "mark")))


def best_of_label(k: int):
    """Solver for blocks of one label: the k best rows of every anchor."""
    def solve(rows, asked, scores):
        value = scores.copy()
        scores[_own(rows, asked)] = LEAST
        r, c = _first(scores, k)
        return pa.RecordBatch.from_arrays(
            [pa.array(_integers(asked, "vec_id")[r]), pa.array(_integers(asked, "mark")[r]),
             pa.array(_integers(rows, "vec_id")[c]), pa.array(_integers(rows, "mark")[c]), pa.array(value[r, c])],
            ["anchor_id", "anchor_mark", "found_id", "found_mark", "score"])

    return solve


def best_in_windows(k: int, low: int, high: int):
    """Solver for blocks of all labels: for every anchor and positive the k best rows of another label
    with ``low`` * positive <= 100 * score <= ``high`` * positive."""
    def solve(rows, asked, scores):
        ids, marks, labels = _integers(rows, "vec_id"), _integers(rows, "mark"), _integers(rows, "label_code")
        out = [[] for _ in range(6)]
        for n, (anchor, mark, label, wanted) in enumerate(zip(
                *(asked.column(c).to_pylist() for c in ("vec_id", "mark", "label_code", "wanted")), strict=True)):
            windows = [(w["place"], -(-low * w["score"] // 100), high * w["score"] // 100) for w in wanted]
            windows = [w for w in windows if w[1] <= w[2]]
            if not windows:
                continue
            s = scores[n]
            some = np.nonzero((s >= min(w[1] for w in windows)) & (s <= max(w[2] for w in windows)) & (labels != label))[0]
            some = some[np.argsort(-s[some], kind="stable")]
            down = -s[some]
            for place, least, most in windows:
                first = int(np.searchsorted(down, -most))
                last = min(first + k, int(np.searchsorted(down, -least, side="right")))
                for c in some[first:last].tolist():
                    for column, value in zip(out, (anchor, mark, place, ids[c], marks[c], s[c]), strict=True):
                        column.append(int(value))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                                          ["anchor_id", "anchor_mark", "place", "found_id", "found_mark", "score"])

    return solve


# --------------------------------------------------------------- operator
def labelled_rows(vectors: DataFrame, vector: Column, label: Column) -> DataFrame:
    """(vec_id, label, vector) of rows that take part; ``vector`` is an array of bigints made from
    the column ``embedding``, whose components decide whether a row takes part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("string").alias("label"),
                           F.col("embedding").cast("array<double>").alias("embedding"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
                    & F.coalesce(finite, F.lit(False)))
            .select("vec_id", "label", vector.alias("vector")).distinct())


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50,
         high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from rows (vec_id,
    label, vector of bigints); ``anchors`` is a condition on them."""
    ship_package(rows.sparkSession)
    rows = stage_table(rows.select("vec_id", "label", "vector", F.size("vector").alias("dim"),
                                   F.xxhash64("label", "vector").alias("mark"),
                                   F.xxhash64("label").alias("label_code")), "negative_rows")
    total = rows.agg(F.sum(F.greatest("dim", F.lit(1)))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_COMPONENTS))
    number = F.pmod(F.xxhash64("vec_id", "mark"), F.lit(blocks))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    columns = ["cell", "kind", "dim", "vec_id", "mark", "label_code", "vector", "wanted"]
    nothing = F.lit(None).cast("array<struct<place:int,score:bigint>>")

    def meet(asked, by, solve, schema):
        def side(df, block, kind):
            return (df.select("*", block.alias("block"))
                    .withColumn("cell", F.concat_ws(":", "dim", "block", *by)).withColumn("kind", F.lit(kind)))

        both = (side(rows.withColumn("wanted", nothing), number, 0).select(*columns)
                .union(side(asked, every, 1).select(*columns)))
        return (both.repartition("cell").sortWithinPartitions("cell", "kind")
                .mapInArrow(lambda batches: _meetings(batches, solve), schema))

    asked = rows.filter(anchors)
    found = meet(asked.withColumn("wanted", nothing), ["label"], best_of_label(positives),
                 "anchor_id long, anchor_mark long, found_id long, found_mark long, score long")
    order = Window.partitionBy("anchor_id", "anchor_mark").orderBy(F.col("score").desc(), "found_id", "found_mark")
    chosen = stage_table(found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
                         .select("anchor_id", "anchor_mark", "place", F.col("found_id").alias("positive_id"),
                                 F.col("score").alias("positive_score")), "negative_positives")
    wanted = chosen.groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor_mark").alias("mark")).agg(
        F.collect_list(F.struct("place", F.col("positive_score").alias("score"))).alias("wanted"))  # at most ``positives``
    found = meet(asked.join(wanted, ["vec_id", "mark"]), [], best_in_windows(negatives, low, high),
                 "anchor_id long, anchor_mark long, place int, found_id long, found_mark long, score long")
    pair = ["anchor_id", "anchor_mark", "place"]
    order = Window.partitionBy(*pair).orderBy(F.col("score").desc(), "found_id", "found_mark")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return best.join(chosen, pair).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                                          F.col("found_id").alias("negative_id"), "positive_score",
                                          F.col("score").alias("negative_score"))


@register("op12_hard_negatives", """
WITH good AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, a.v AS anchor, c.vec_id, c.label,
         CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM good a JOIN good c
    ON len(a.v) = len(c.v) AND NOT (a.vec_id = c.vec_id AND a.label = c.label AND a.v = c.v)
  WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id, anchor_label, anchor
                                              ORDER BY score DESC, vec_id) AS place
                 FROM scored WHERE label = anchor_label) WHERE place <= 5),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
         n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.anchor_label, p.anchor, p.place
                            ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n
    ON n.anchor_id = p.anchor_id AND n.anchor_label = p.anchor_label AND n.anchor = p.anchor
   AND n.label <> n.anchor_label AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 3""")
def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    floors = F.transform("embedding", lambda x: F.floor(x * F.lit(256.0)).cast("long"))
    rows = labelled_rows(table(spark, sf_dir, "embeddings"), floors, label)
    return mine(rows, F.col("vec_id") % 50 == 0)
