"""Exact top-k by inner product with norm buckets.

Vectors are grouped by length into global buckets whose lengths lie within ``RATIO`` of each
other, and taken from the longest down in rounds (adjacent buckets together, each round about
as many rows as all before it, so there are few rounds). A query carries its k-th best score
so far as its threshold from round to round. A round's rows are only joined with the queries
whose threshold its longest vector can reach; when there are none, this and all shorter
vectors are never shuffled.

Within a round vectors are dealt by hash into candidate blocks of bounded size, queries into
query blocks; every query block meets every candidate block in its own cell (block nested
loop, one equi-join of cell numbers). Within a cell the candidates are sorted by length
and cut into buckets whose lengths lie within ``RATIO`` of each other. Buckets are taken
from the longest down with each query's k-th best score so far as its threshold t:

* the local cosine threshold of a bucket is t / (|q| * longest length in it). Above 1 no
  vector of this bucket can enter, and the query skips it (length pruning of a bucket);
* at ``COORDINATE`` or more, the coordinate method: a vector p with cosine of at least c
  to q has, in each of the query's largest coordinates, a value in the range
  q_f c ± sqrt((1 - c²)(1 - q_f²)); vectors outside are skipped;
* below that, the length method: vectors of the bucket shorter than t / |q| are skipped.

What is left is verified by its exact integer product. Pruning keeps ties (bounds are
loosened by a rounding margin), so equal scores are decided by id. Cells return k rows a
query; a window limited per group before its shuffle merges them.

Exactness: components are integers; products are summed in doubles when they stay below
2^53 and in 64-bit integers otherwise (beyond 64 bits sums wrap).

Defined results: vectors that are null or hold null or non-finite components take no
part; a repeated id counts once with its smallest vector; only vectors of one dimension
are compared with each other (so an empty vector meets empty ones, score 0); copies tie
and go by id; a query with fewer candidates than k gets all; extra columns are ignored;
no queries or an empty table give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.registry import register, table
from skyledger.llm.vectors import best, smallest_copies, usable
from skyledger.session import ship_package, stage_table

RATIO = 0.9
BUCKET_ROWS = 1024
COORDINATE = 0.8
FOCUS = 4
BLOCK_ROWS, QUERY_ROWS = 16_384, 1024
ROUND_ROWS = 65_536
EXACT = float(1 << 53)


def cell_top(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, bar=None):
    """Rows (query number, id, score) of the k best candidates of each query; integer matrices. ``bar``
    has scores below which a query needs none."""
    q_len = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    length = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((ids, -length))
    vectors, ids, length = vectors[order], ids[order], length[order]
    top = max(np.abs(queries).max(initial=0), 1) * float(max(np.abs(vectors).max(initial=0), 1))
    small = top * max(1, queries.shape[1]) < EXACT
    q_calc = queries.astype(np.float64) if small else queries
    focus = np.argsort(-np.abs(queries), axis=1)[:, :FOCUS]
    q_unit = queries / np.maximum(q_len, 1e-300)[:, None]
    scores = [np.zeros(0, dtype=np.int64)] * len(queries)
    found = [np.zeros(0, dtype=np.int64)] * len(queries)
    threshold = np.full(len(queries), -np.inf) if bar is None else bar.copy()
    at = 0
    while at < len(vectors):
        longest = length[at]
        end = at + int(np.searchsorted(-length[at:at + BUCKET_ROWS], -RATIO * longest, side="right"))
        end = max(end, at + 1)
        bound = q_len * longest
        local = np.where(bound > 0, threshold / np.where(bound > 0, bound, 1.0),
                         np.where(threshold > 0, np.inf, -np.inf))
        local = np.where(np.isneginf(threshold), -np.inf, local) - 1e-9
        live = np.nonzero(local <= 1)[0]
        coordinate = live[local[live] >= COORDINATE]
        plain = live[local[live] < COORDINATE]
        bucket = vectors[at:end].astype(np.float64) if small else vectors[at:end]
        unit = None
        for q in coordinate:
            if unit is None:
                unit = vectors[at:end] / np.maximum(length[at:end], 1e-300)[:, None]
            c, keep = local[q], np.ones(end - at, dtype=bool)
            for f in focus[q]:
                x = q_unit[q, f]
                wide = np.sqrt(max(0.0, (1 - c * c) * (1 - x * x))) + 1e-9
                keep &= (unit[:, f] >= x * c - wide) | (x < 0)
                keep &= (unit[:, f] <= x * c + wide) | (x > 0)
            rows = np.nonzero(keep)[0]
            _merge(q, bucket[rows] @ q_calc[q], ids[at:end][rows], query_ids, scores, found, threshold, k)
        if len(plain):
            need = np.where(q_len[plain] > 0, threshold[plain] / np.maximum(q_len[plain], 1e-300), -np.inf)
            rows = int(np.searchsorted(-length[at:end], -(need.min() * (1 - 1e-9)), side="right"))
            product = bucket[:rows] @ q_calc[plain].T
            for n, q in enumerate(plain):
                some = np.nonzero(product[:, n] >= threshold[q])[0]
                _merge(q, product[some, n], ids[at:end][some], query_ids, scores, found, threshold, k)
        at = end
    number = np.repeat(np.arange(len(queries)), [len(s) for s in scores])
    return number, np.concatenate([*found, np.zeros(0, np.int64)]), np.concatenate([*scores, np.zeros(0, np.int64)])


def _merge(q, product, ids, query_ids, scores, found, threshold, k):
    other = ids != query_ids[q]
    s = np.concatenate([scores[q], product[other].astype(np.int64)])
    i = np.concatenate([found[q], ids[other]])
    order = np.lexsort((i, -s))[:k]
    scores[q], found[q] = s[order], i[order]
    if len(order) == k:
        threshold[q] = max(threshold[q], scores[q][-1])


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), dim)


def _length() -> Column:
    return F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def rounds(vectors: DataFrame, least_rows: int) -> list[tuple[float, float, float]]:
    """(shortest, longest, rows) of each round from the longest vectors down: whole buckets, at least
    ``least_rows`` rows and as many as all rounds before."""
    bucket = F.when(F.col("length") > 0, F.floor(F.log("length") / math.log(1 / RATIO))).alias("bucket")
    sizes = vectors.groupBy(bucket).agg(F.count("*").alias("n"), F.min("length").alias("low"), F.max("length").alias("high"))
    out, done, held = [], 0, None
    for r in sorted(sizes.collect(), key=lambda r: -r.high):  # a double has at most 13,500 buckets
        held = (r.low, held[1] if held else r.high, (held[2] if held else 0) + r.n)
        if held[2] >= max(least_rows, done):
            out.append(held)
            done, held = done + held[2], None
    return [*out, held] if held else out


def top_k(vectors: DataFrame, queries: DataFrame, k: int, round_rows: int = ROUND_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k highest integer inner products; both sides
    have (vec_id, vector: array<bigint>). A query's own id is no candidate."""
    ship_package(vectors.sparkSession)
    vectors = stage_table(vectors.select("vec_id", "vector").withColumn("length", _length()), "topk_lengths")
    queries = stage_table(queries.select("vec_id", "vector").withColumn("length", _length()), "topk_queries")
    found = None
    for low, high, n in rounds(vectors, round_rows):
        some = vectors.filter(F.col("length").between(low, high)).drop("length")
        if found is None:
            live = queries.select("vec_id", "vector", F.lit(None).cast("double").alias("bar"))
        else:
            bars = found.groupBy(F.col("query_id").alias("vec_id")).agg(
                F.when(F.count("*") == k, F.min("score").cast("double")).alias("bar"))
            reach = F.col("length") * F.lit(high * (1 + 1e-9))
            live = stage_table(queries.join(bars, "vec_id", "left").filter(F.col("bar").isNull() | (F.col("bar") <= reach))
                               .select("vec_id", "vector", "bar"), "topk_live")
            if live.isEmpty():
                break
        more = best(_cells(some, live, k, n), k)
        if found is not None:
            columns = ["query_id", "vec_id", "score"]
            more = best(found.select(*columns).union(more.select(*columns)), k)
        found = stage_table(more, "topk_found")
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return found


def _cells(vectors: DataFrame, queries: DataFrame, k: int, n: int) -> DataFrame:
    """query_id, vec_id, score of k candidates per cell and query; queries have a ``bar`` (null: none)."""
    vectors, queries = vectors.withColumn("dim", F.size("vector")), queries.withColumn("dim", F.size("vector"))
    m = queries.count()
    parts, query_parts = max(1, -(-n // BLOCK_ROWS)), max(1, -(-m // QUERY_ROWS))

    def numbers(count):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    side = [F.pmod(F.xxhash64("vec_id"), F.lit(p)).cast("int") for p in (parts, query_parts)]
    candidates = vectors.select("dim", side[0].alias("c"), numbers(query_parts).alias("q"), "vec_id", "vector")
    asked = queries.select("dim", numbers(parts).alias("c"), side[1].alias("q"), "vec_id", "vector",
                           F.coalesce("bar", F.lit(float("-inf"))).alias("bar"))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            dim = left.column("dim")[0].as_py()
            query_ids = right.column("vec_id").to_numpy()
            number, ids, scores = cell_top(_matrix(right.column("vector"), dim), query_ids,
                                           _matrix(left.column("vector"), dim), left.column("vec_id").to_numpy(), k,
                                           right.column("bar").to_numpy())
            out = {"query_id": query_ids[number], "vec_id": ids, "score": scores}
        return pa.table(out, schema=pa.schema([(c, pa.int64()) for c in out]))

    return (candidates.groupBy("dim", "c", "q").cogroup(asked.groupBy("dim", "c", "q"))
            .applyInArrow(cell, "query_id long, vec_id long, score long"))


def to_integers(vectors: DataFrame, scale: int) -> DataFrame:
    """Every component x becomes floor(scale * x)."""
    return vectors.withColumn("vector", F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))).cast("long")))


@register("op4_norm_buckets", """
WITH good AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM (SELECT vec_id, min(embedding) AS embedding FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        GROUP BY vec_id)),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""")
def op4_norm_buckets(spark, sf_dir):
    k = 10
    vectors = stage_table(to_integers(usable(table(spark, sf_dir, "embeddings")), 1024), "topk_vectors")
    return top_k(smallest_copies(vectors, "vector", k + 1), vectors.filter("vec_id % 100 = 0"), k)
