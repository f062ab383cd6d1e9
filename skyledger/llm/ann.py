"""Approximate nearest neighbours by balanced posting lists (largest inner product).

Geometry: with M the largest length, x becomes (x, sqrt(M² - |x|²)) / M and a query
(q, 0) / |q|. All points lie on the unit sphere and the nearest one has the largest
inner product, whatever the lengths.

Index: centroids come from a k-means whose assignment is charged for crowded clusters
(balance), fitted on at most about ``SAMPLE`` vectors chosen by a hash of their id; there
is one centroid for every ``LIST_ROWS`` vectors, up to ``MAX_LISTS``. Every vector is
indexed: in the list of its nearest centroid and, if it lies at a boundary, in up to
``REPLICAS`` lists whose centroids are at most ``1 + BOUNDARY`` times as far, leaving out
centroids closer to a chosen one than to the vector. Lists are gathered into groups of
about ``GROUP_ROWS`` rows; a longer list is split by hash, so no list, however hot, is
one task's work.

Centroids are put back on the sphere, so a vector between lists is about as near to their
centroids as these are to each other, and is replicated.

Search: a best-first walk of a neighbour graph of the centroids, in memory and for a
block of queries at a time, gives a query's nearest centroids. Distance-ratio pruning
keeps lists whose centroid is at most ``ratio`` times as far as the nearest one, and more
while they hold too few vectors. ``ratio`` is measured, not guessed: for ``PROBES`` sample
vectors the true neighbours are found by a full scan, and the ratio is the one at which
``COVER`` of them are in a selected list. Candidates are shortlisted by matrix products
and scored again in double precision, component by component in order, so equal vectors
have equal scores wherever they are found. Queries are blocked with those of the same
nearest list, so a block asks for few groups, and a group of lists is copied only to the
blocks that ask for it.

Only bounded data reaches the driver or a closure: the sample, the centroids, one count
per list, and the probes' neighbours.

Defined results: vectors that are null, zero, or hold null or non-finite components take
no part, nor do vectors of another dimension than the commonest one (ties: the smaller);
a repeated id counts once with its smallest vector; copies tie and go by id; with fewer
candidates than k a query gets all; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.registry import register, table
from skyledger.llm.vectors import best, smallest_copies, usable
from skyledger.operators.sizing import bounded_broadcast
from skyledger.session import ship_package, stage_table

SAMPLE = 32_768
LIST_ROWS, MAX_LISTS = 256, 4096
REPLICAS, BOUNDARY = 4, 0.1
DEGREE, BEAM = 24, 256
PROBES, COVER = 64, 0.97
GROUP_ROWS, QUERY_ROWS = 16_384, 4096
PRODUCTS = 1 << 22  # of one matrix
ROUNDS, CHARGE = 8, 0.05
SEED = 17


# ------------------------------------------------------------------ index
def on_sphere(x: np.ndarray, longest: float) -> np.ndarray:
    x = x / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (x ** 2).sum(axis=1)))
    return np.concatenate([x, rest[:, None]], axis=1)


def query_on_sphere(q: np.ndarray) -> np.ndarray:
    unit = q / np.linalg.norm(q, axis=1, keepdims=True)
    return np.concatenate([unit, np.zeros((len(q), 1))], axis=1)


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    square = (points ** 2).sum(axis=1)[:, None] + (centroids ** 2).sum(axis=1) - 2 * points @ centroids.T
    return np.sqrt(np.maximum(square, 0.0))


def balanced_centroids(points: np.ndarray, lists: int) -> np.ndarray:
    """k-means whose distance grows with a cluster's share of the points."""
    rng = np.random.default_rng(SEED)
    centroids = points[rng.choice(len(points), lists, replace=False)].copy()
    share = np.ones(lists)
    for _ in range(ROUNDS):
        owner = np.concatenate([np.argmin(distances(points[a:a + 4096], centroids) + CHARGE * (share - 1), axis=1)
                                for a in range(0, len(points), 4096)])
        size = np.bincount(owner, minlength=lists)
        order = np.argsort(owner, kind="stable")
        full = np.nonzero(size)[0]
        sums = np.add.reduceat(points[order], (np.cumsum(size) - size)[full], axis=0)
        centroids[full] = sums / size[full][:, None]
        empty = np.nonzero(size == 0)[0]
        centroids[empty] = points[rng.choice(len(points), len(empty))]
        # back onto the sphere: inside it, centroids lie nearer to each other than to the points
        centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
        share = size * lists / len(points)
    return centroids


def neighbour_graph(centroids: np.ndarray) -> np.ndarray:
    """Each centroid's nearest others, and the next one in order, which keeps it connected."""
    n = len(centroids)
    degree = min(DEGREE, n - 1)
    ring = ((np.arange(n) + 1) % n)[:, None]
    if degree < 1:
        return ring
    near = []
    for a in range(0, n, 512):
        gap = distances(centroids[a:a + 512], centroids)
        gap[np.arange(len(gap)), np.arange(a, a + len(gap))] = np.inf
        near.append(np.argsort(gap, axis=1)[:, :degree])
    near = np.concatenate(near)
    twice = (near == ring).any(axis=1)  # then the place holds the centroid itself, which a walk has seen
    return np.concatenate([near, np.where(twice, np.arange(n), ring[:, 0])[:, None]], axis=1)


def graph_search(points: np.ndarray, centroids: np.ndarray, graph: np.ndarray, beam: int):
    """(lists, distances) of each point's nearest centroids, nearest first: a best-first walk from
    one entry, for all points at once. Unused places hold -1 and infinity."""
    n, width = len(points), min(beam, len(centroids))
    entry = int(np.argmin(distances(centroids.mean(axis=0)[None, :], centroids)[0]))
    lists = np.full((n, width), -1)
    far = np.full((n, width), np.inf)
    open_ = np.zeros((n, width), dtype=bool)
    seen = np.zeros((n, len(centroids)), dtype=bool)
    lists[:, 0], open_[:, 0], seen[:, entry] = entry, True, True
    far[:, 0] = distances(points, centroids[entry:entry + 1])[:, 0]
    live = np.arange(n)
    while len(live):
        step = np.where(open_[live], far[live], np.inf).argmin(axis=1)
        live, step = live[open_[live, step]], step[open_[live, step]]
        if not len(live):
            break
        open_[live, step] = False
        ask = graph[lists[live, step]]
        new = ~seen[live[:, None], ask]
        seen[live[:, None], ask] = True
        gap = np.sqrt(((centroids[ask] - points[live][:, None, :]) ** 2).sum(axis=2))
        gap = np.where(new, gap, np.inf)
        all_far = np.concatenate([far[live], gap], axis=1)
        keep = np.argsort(all_far, axis=1, kind="stable")[:, :width]
        rows = np.arange(len(live))[:, None]
        far[live] = all_far[rows, keep]
        lists[live] = np.concatenate([lists[live], ask], axis=1)[rows, keep]
        open_[live] = np.concatenate([open_[live], new], axis=1)[rows, keep] & np.isfinite(far[live])
    lists[~np.isfinite(far)] = -1
    return lists, far


def postings_of(points: np.ndarray, centroids: np.ndarray):
    """(point number, list, is the nearest) of every posting."""
    apart = distances(centroids, centroids)
    number, lists, first = [], [], []
    for a in range(0, len(points), 4096):
        gap = distances(points[a:a + 4096], centroids)
        width = min(len(centroids), 4 * REPLICAS)
        near = np.argpartition(gap, width - 1, axis=1)[:, :width]
        near = np.take_along_axis(near, np.argsort(np.take_along_axis(gap, near, axis=1), axis=1, kind="stable"), axis=1)
        d = np.take_along_axis(gap, near, axis=1)
        chosen = np.zeros(near.shape, dtype=bool)
        chosen[:, 0] = True
        for j in range(1, width):
            hidden = (chosen[:, :j] & (apart[near[:, :j], near[:, j:j + 1]] < d[:, j:j + 1])).any(axis=1)
            chosen[:, j] = (d[:, j] <= (1 + BOUNDARY) * d[:, 0]) & ~hidden & (chosen.sum(axis=1) < REPLICAS)
        at, place = np.nonzero(chosen)
        number.append(a + at)
        lists.append(near[at, place])
        first.append(place == 0)
    return np.concatenate(number), np.concatenate(lists), np.concatenate(first)


def _matrix(column, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), dim)


def exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Row-by-row inner products, components added in order."""
    out = np.zeros(len(queries))
    for j in range(queries.shape[1]):
        out = out + queries[:, j] * vectors[:, j]
    return out


def top_of(queries, vectors, ids, query_ids, k):
    """(query number, id, score) of each query's k best rows of one block; ids may repeat."""
    product = queries @ vectors.T
    if len(vectors) > k + 1:  # the query's own row may be among them
        bar = -np.partition(-product, k, axis=1)[:, k]
        q, v = np.nonzero(product >= (bar - 1e-9 * (1 + np.abs(bar)))[:, None])
    else:
        q, v = (x.ravel() for x in np.indices(product.shape))
    other = ids[v] != query_ids[q]
    q, v = q[other], v[other]
    return first_k(q, ids[v], exact_scores(queries[q], vectors[v]), k)


def first_k(q, ids, score, k):
    """Best k distinct ids of each query number, by score and then id."""
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    if len(q):  # replicas of one vector have one score, so they are adjacent
        keep = np.concatenate([[True], (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])])
        q, ids, score = q[keep], ids[keep], score[keep]
        start = np.nonzero(np.concatenate([[True], q[1:] != q[:-1]]))[0]
        rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
        q, ids, score = q[rank < k], ids[rank < k], score[rank < k]
    return q, ids, score


def query_blocks(sizes: list[int]) -> list[tuple[int, int, int]]:
    """(home group, first block, blocks) for groups with so many queries each: neighbours share a block
    of at most about QUERY_ROWS queries, a larger group has blocks of its own."""
    out, block, filled = [], 0, 0
    for home, n in enumerate(sizes):
        if filled and filled + n > QUERY_ROWS:
            block, filled = block + 1, 0
        own = max(1, -(-n // QUERY_ROWS))
        out.append((home, block, own))
        filled += n
        if own > 1:
            block, filled = block + own, 0
    return out


class Index:
    """Posting lists over (vec_id, vector: array<double>) rows, unique by vec_id."""

    def __init__(self, vectors: DataFrame, k: int):
        self.spark, self.k = vectors.sparkSession, k
        ship_package(self.spark)
        length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
        sized = vectors.withColumn("length", length).filter("length > 0").withColumn("dim", F.size("vector"))
        dims = sized.groupBy("dim").agg(F.count("*").alias("n"), F.max("length").alias("longest"))
        common = dims.orderBy(F.col("n").desc(), "dim").first()
        self.n = common.n if common else 0
        if not self.n:
            return
        self.dim, self.longest = common.dim, float(common.longest)
        self.rows = stage_table(
            smallest_copies(sized.filter(F.col("dim") == self.dim).select("vec_id", "vector"), "vector", k + 1),
            "ann_rows")
        self.n = self.rows.count()
        part = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(1 << 30))
        share = min(1.0, SAMPLE / self.n)
        sample = self.rows.filter(part < int(share * (1 << 30)) + 1).limit(2 * SAMPLE).toArrow()
        sample = sample.sort_by("vec_id")
        points = _matrix(sample.column("vector"), self.dim)
        lists = max(1, min(MAX_LISTS, self.n // LIST_ROWS, len(points) // 4))
        self.centroids = balanced_centroids(on_sphere(points, self.longest), lists)
        self.graph = neighbour_graph(self.centroids)
        self.postings = stage_table(self._post(), "ann_postings")
        count = self.postings.groupBy("list").agg(F.count("*").alias("n"), F.sum(F.col("first").cast("int")).alias("own"))
        self.size, self.own = np.zeros(lists, dtype=np.int64), np.zeros(lists, dtype=np.int64)
        for r in count.collect():  # one row a list
            self.size[r.list], self.own[r.list] = r.n, r.own
        probes = np.random.default_rng(SEED).permutation(len(points))[:PROBES]
        self.ratio = self._measure(sample.column("vec_id").to_numpy()[probes], points[probes])
        self._group()

    def _post(self) -> DataFrame:
        centroids, longest, dim = self.centroids, self.longest, self.dim

        def run(batches):
            for batch in batches:
                if not len(batch):
                    continue
                points = on_sphere(_matrix(batch.column(1), dim), longest)
                number, lists, first = postings_of(points, centroids)
                take = pa.array(number)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists.astype(np.int32)), pa.array(first), batch.column(0).take(take),
                     batch.column(1).take(take)], ["list", "first", "vec_id", "vector"])

        return self.rows.select("vec_id", "vector").mapInArrow(
            run, "list int, first boolean, vec_id long, vector array<double>")

    def _measure(self, probe_ids: np.ndarray, probes: np.ndarray) -> float:
        """The distance ratio at which COVER of the probes' true neighbours are in a selected list."""
        k, dim = self.k, self.dim

        def scan(batches):
            for batch in batches:
                if len(batch):
                    q, ids, score = top_of(probes, _matrix(batch.column(1), dim), batch.column(0).to_numpy(),
                                           probe_ids, k)
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids), pa.array(score)],
                                                     ["query_id", "vec_id", "score"])

        found = best(self.rows.select("vec_id", "vector").mapInArrow(
            scan, "query_id long, vec_id long, score double"), k)
        where = found.join(self.postings.select("vec_id", "list"), "vec_id").select("query_id", "vec_id", "list")
        gap = distances(query_on_sphere(probes), self.centroids)
        need: dict[tuple, float] = {}
        for r in where.collect():  # at most PROBES * k * REPLICAS rows
            ratio = gap[r.query_id, r.list] / max(gap[r.query_id].min(), 1e-12)
            need[r.query_id, r.vec_id] = min(ratio, need.get((r.query_id, r.vec_id), np.inf))
        return float(np.quantile(list(need.values()), COVER)) if need else 1.0

    def _group(self) -> None:
        """Lists in an order that keeps near ones together, cut into groups of about GROUP_ROWS rows;
        a longer list has groups of its own, among which its rows are dealt by hash."""
        middle = self.centroids - self.centroids.mean(axis=0)
        axis = np.linalg.svd(middle, full_matrices=False)[2][0]
        self.parts = np.maximum(1, -(-self.size // GROUP_ROWS))
        self.group, groups, filled = np.zeros(len(self.size), dtype=np.int64), 0, 0
        for c in np.argsort(middle @ axis, kind="stable").tolist():
            if filled and (filled + self.size[c] > GROUP_ROWS or self.parts[c] > 1):
                groups, filled = groups + 1, 0
            self.group[c] = groups
            filled += int(self.size[c])
            if self.parts[c] > 1:
                groups, filled = groups + int(self.parts[c]), 0
        self.groups = groups + 1

    def select(self, points: np.ndarray):
        """Lists to search for points on the sphere: (point number, list), and each point's nearest list."""
        lists, far = graph_search(points, self.centroids, self.graph, BEAM)
        nearest = lists[:, 0]
        wide = (np.isfinite(far).all(axis=1) & (far[:, -1] <= self.ratio * far[:, 0])
                & (lists.shape[1] < len(self.centroids)))
        chosen = (far <= self.ratio * far[:, :1]) & (lists >= 0)
        own = np.where(lists >= 0, self.own[lists], 0)
        chosen |= (np.cumsum(own, axis=1) - own <= self.k) & (lists >= 0)
        short = (own * chosen).sum(axis=1) <= self.k  # the walk found too few vectors: take all lists
        number, place = np.nonzero(chosen & ~(wide | short)[:, None])
        whole = np.nonzero(wide | short)[0]  # the beam ended before the ratio did: measure every centroid
        number, lists = [number], [lists[number, place]]
        for a in range(0, len(whole), 1024):
            gap = distances(points[whole[a:a + 1024]], self.centroids)
            q, c = np.nonzero((gap <= self.ratio * gap.min(axis=1)[:, None]) | short[whole[a:a + 1024]][:, None])
            number.append(whole[a + q])
            lists.append(c)
        return np.concatenate(number), np.concatenate(lists), nearest

    def search(self, queries: DataFrame) -> DataFrame:
        """query_id, rank, vec_id, score for (vec_id, vector) query rows of the index's dimension."""
        k, dim = self.k, self.dim
        # what the tasks need of the index: small arrays only
        plain = Index.__new__(Index)
        for name in ("centroids", "graph", "ratio", "own", "k", "group", "parts"):
            setattr(plain, name, getattr(self, name))
        def ask(batches):
            for batch in batches:
                if not len(batch):
                    continue
                number, lists, nearest = plain.select(query_on_sphere(_matrix(batch.column(1), dim)))
                home = plain.group[nearest]
                copies = plain.parts[lists]
                number, lists = np.repeat(number, copies), np.repeat(lists, copies)
                turn = np.arange(len(lists)) - np.repeat(np.cumsum(copies) - copies, copies)
                group = plain.group[lists] + turn
                order = np.lexsort((lists, group, number))
                number, lists, group = number[order], lists[order], group[order]
                start = np.nonzero(np.concatenate([[True], (number[1:] != number[:-1])
                                                   | (group[1:] != group[:-1])]))[0]
                wanted = pa.ListArray.from_arrays(pa.array(np.append(start, len(lists)).astype(np.int32)),
                                                  pa.array(lists.astype(np.int32)))
                take = pa.array(number[start])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group[start].astype(np.int32)), pa.array(home[number[start]].astype(np.int32)),
                     batch.column(0).take(take), batch.column(1).take(take), wanted],
                    ["g", "home", "vec_id", "vector", "lists"])

        asked = stage_table(queries.select("vec_id", "vector").mapInArrow(
            ask, "g int, home int, vec_id long, vector array<double>, lists array<int>"), "ann_asked")
        counts = {r.home: r.n for r in asked.filter("g = home").groupBy("home").agg(F.count("*").alias("n")).collect()}
        blocks = F.broadcast(self.spark.createDataFrame(  # one row a group, at most MAX_LISTS
            query_blocks([counts.get(h, 0) for h in range(self.groups)]), "home int, block int, blocks int"))
        asked = asked.join(blocks, "home").withColumn(
            "q", F.col("block") + F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).drop("home", "block", "blocks")
        cells = stage_table(asked.select("g", "q").distinct(), "ann_cells")
        homes = F.broadcast(self.spark.createDataFrame(  # one row a list, at most MAX_LISTS
            [(c, int(g), int(p)) for c, (g, p) in enumerate(zip(self.group, self.parts, strict=True))],
            "list int, home int, parts int"))
        posted = (self.postings.join(homes, "list")
                  .select((F.col("home") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).cast("int").alias("g"),
                          "list", "vec_id", "vector").join(bounded_broadcast(cells, 16 << 20), "g"))

        def cell(left: pa.Table, right: pa.Table) -> pa.Table:
            q_out, id_out, s_out = [], [], []
            if len(left) and len(right):
                lists = left.column("list").to_numpy()
                order = np.argsort(lists, kind="stable")
                lists = lists[order]
                vectors = _matrix(left.column("vector"), dim)[order]
                ids = left.column("vec_id").to_numpy()[order]
                asked_by = right.column("lists").combine_chunks()
                asker = np.repeat(np.arange(len(right)), np.diff(asked_by.offsets.to_numpy()))
                wanted = asked_by.flatten().to_numpy()
                points = _matrix(right.column("vector"), dim)
                query_ids = right.column("vec_id").to_numpy()
                for c in np.unique(lists).tolist():
                    some = asker[wanted == c]
                    if len(some):
                        a, b = np.searchsorted(lists, [c, c + 1])
                        step = max(1, PRODUCTS // (b - a))
                        for part in (some[at:at + step] for at in range(0, len(some), step)):
                            q, i, s = top_of(points[part], vectors[a:b], ids[a:b], query_ids[part], k)
                            q_out.append(part[q])
                            id_out.append(i)
                            s_out.append(s)
            if q_out:
                q, i, s = first_k(np.concatenate(q_out), np.concatenate(id_out), np.concatenate(s_out), k)
                q = query_ids[q]
            else:
                q, i, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()),
                             "score": pa.array(s, pa.float64())})

        found = (posted.groupBy("g", "q").cogroup(asked.groupBy("g", "q"))
                 .applyInArrow(cell, "query_id long, vec_id long, score double"))
        return best(found.distinct(), k)


def search(vectors: DataFrame, wanted, k: int) -> DataFrame:
    """Each query's k nearest found; ``wanted`` is the condition that makes a row a query."""
    rows = stage_table(usable(vectors), "ann_vectors")
    index = Index(rows, k)
    if not index.n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    return index.search(rows.filter(wanted & (F.size("vector") == index.dim) & (size > 0)))


@register("op8_posting_lists")
def op8_posting_lists(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)
