"""Mixing sources to target weights.

Targets: sources in code-point order (null last) weigh ``WEIGHTS``, repeating, and share
the words of the whole corpus; a source stops at ``MAX_REPEATS`` times its own size, and
the excess is shared by weight again until no source is above.

The words of a source, laid end to end in an order fixed by its documents, are packed
into blocks of one fixed length (at most ``BLOCK_WORDS``; shorter for a small source, so
that it still has about ``MIN_BLOCKS`` blocks and its target can be met closely). The
output is a list of shards of equal slot counts. Each shard draws its source counts from
a multinomial distribution in proportion to the targets, with a generator seeded by the
shard number, so shards are drawn in parallel and reruns agree. Independent draws miss a
source's total by about the square root of it; the slots that a source drew beyond its
total are handed, in order, to the sources that drew too few. Slot j of a source goes
through a pseudorandom permutation of its block indices (a Feistel network with cycle
walking, keyed by source and pass), pass ``j div blocks``; so a pass takes every block at
most once, and no block is taken more than ``MAX_REPEATS`` times. Blocks and documents
meet by an equi-join on (source, block index).

Skew: a hot source is laid out by prefix sums over hash buckets of a bounded number of
documents, not by one window; joins use (source, block), which no source dominates. They
are merge joins by hint: slots are made from a small table of draws, whose size says
nothing about theirs, so the planner would broadcast them.
Repeated rows (same source, doc_id and text) are counted before the shuffle and share
one stretch of the source; they are interchangeable.

Defined results: a null text has size 0 and nothing taken; a null source is a source; a
null doc_id stays null; extra columns are ignored by ``mix`` and kept by
``mixed_documents``; an empty table gives no rows. Sources are a catalogue: more than
``max_sources`` of them are an error, not a cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.registry import register, table
from skyledger.llm.simhash import smallest_row
from skyledger.llm.workers import give_back
from skyledger.session import ship_package, stage_table

#: Fixed values of the mix.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"

BLOCK_WORDS, MIN_BLOCKS = 512, 1024
SHARD_SLOTS = 1 << 16
BUCKET_ROWS = 20_000
MAX_SOURCES = 100_000
SEED = 11

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # splitmix64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def share(sizes: list[int], weights: list[int], most: int = MAX_REPEATS) -> list[float]:
    """Targets: the sum of ``sizes`` shared by weight, none above ``most`` times its size."""
    total, capped = sum(sizes), set()
    while True:
        rest = total - sum(most * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        targets = [float(most * s) if i in capped else rest * weights[i] / weight
                   for i, s in enumerate(sizes)]
        above = {i for i, s in enumerate(sizes) if i not in capped and targets[i] > most * s}
        if not above:
            return targets
        capped |= above


# ---------------------------------------------------------- permutations
def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Place of each index under a pseudorandom permutation of range(n) named by ``key``: a
    four-round Feistel network on an even number of bits, walked until the value is below n."""
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    with np.errstate(over="ignore"):
        rounds = _scramble(np.uint64(key) + np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        while todo.any():
            left, right = out[todo] >> half, out[todo] & mask
            for r in rounds:
                left, right = right, left ^ (_scramble(right ^ r) & mask)
            out[todo] = left << half | right
            todo[todo] = out[todo] >= np.uint64(n)
    return out.astype(np.int64)


# ------------------------------------------------------------------- plan
class Mix:
    """The plan of a mix over ``docs`` (doc_id, text, source): sources, documents, slots."""

    def __init__(self, docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS,
                 max_sources: int = MAX_SOURCES, seed: int = SEED):
        self.spark, self.seed, self.shard_slots = docs.sparkSession, seed, shard_slots
        ship_package(self.spark)
        self.units = stage_table(
            docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64("text").alias("text_hash"), word_count(F.col("text")).alias("size"),
                        F.spark_partition_id().alias("part"))
            .groupBy("source", "doc_id", "text_hash", "size", "part").agg(F.count("*").alias("copies")), "mix_units")
        totals = (self.units.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("size"),
                                                   F.count("*").alias("units"))
                  .limit(max_sources + 1).collect())
        if len(totals) > max_sources:
            raise ValueError(f"more than {max_sources} sources")
        totals.sort(key=lambda r: (r.source is None, (r.source or "").encode()))
        self.names = [r.source for r in totals]
        self.sizes = [int(r.size) for r in totals]
        self.n_units = sum(r.units for r in totals)
        self.targets = share(self.sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(totals))])
        self.block = [max(1, min(block_words, s // MIN_BLOCKS)) for s in self.sizes]
        self.blocks = [-(-s // b) for s, b in zip(self.sizes, self.block, strict=True)]
        self.quota = [min(MAX_REPEATS * n, round(t * n / s)) if s else 0
                      for t, n, s in zip(self.targets, self.blocks, self.sizes, strict=True)]

    def sources(self) -> DataFrame:
        rows = [(i, name, s, float(t), b) for i, (name, s, t, b) in enumerate(
            zip(self.names, self.sizes, self.targets, self.block, strict=True))]
        return F.broadcast(self.spark.createDataFrame(  # at most max_sources rows
            rows, "source_no int, name string, source_size long, target double, block_words long"))

    def slots(self) -> DataFrame:
        """(shard, source_no, pass, block): one row per slot of every output shard."""
        total, seed, per_shard = sum(self.quota), self.seed, self.shard_slots
        quota, blocks = np.array(self.quota, dtype=np.int64), self.blocks
        out = "shard long, source_no int, pass int, block long"
        if not total:
            return self.spark.createDataFrame([], out)
        shards = -(-total // per_shard)

        def draw(batches):
            for batch in batches:
                shard, source, drawn = [], [], []
                for k in batch.column(0).to_pylist():
                    rng = np.random.Generator(np.random.Philox(key=[seed, k]))
                    counts = rng.multinomial(min(per_shard, total - k * per_shard), quota / total)
                    for s in np.nonzero(counts)[0].tolist():
                        shard.append(k)
                        source.append(s)
                        drawn.append(int(counts[s]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int64()), pa.array(source, pa.int32()), pa.array(drawn, pa.int64())],
                    ["shard", "source_no", "drawn"])

        draws = stage_table(self.spark.range(shards).mapInArrow(draw, "shard long, source_no int, drawn long"),
                            "mix_draws")
        drawn = np.zeros(len(quota), dtype=np.int64)
        for r in draws.groupBy("source_no").agg(F.sum("drawn").alias("n")).collect():  # one row a source
            drawn[r.source_no] = r.n
        over, under = np.maximum(drawn - quota, 0), np.maximum(quota - drawn, 0)
        over_first, under_end = np.cumsum(over) - over, np.cumsum(under)

        def place(batches):
            for batch in batches:
                for shard, source, first, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    j = np.arange(first, first + n)
                    owner = np.full(n, source)
                    beyond = j >= quota[source]
                    spare = over_first[source] + j[beyond] - quota[source]
                    owner[beyond] = np.searchsorted(under_end, spare, side="right")
                    to = owner[beyond]
                    j[beyond] = drawn[to] + spare - (under_end[to] - under[to])
                    for s in np.unique(owner).tolist():
                        mine = j[owner == s]
                        turn = mine // blocks[s]
                        for p in np.unique(turn).tolist():
                            at = permute(mine[turn == p] % blocks[s], blocks[s], seed + 1_000_003 * s + p)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(at), shard)), pa.array(np.full(len(at), s, dtype=np.int32)),
                                 pa.array(np.full(len(at), p, dtype=np.int32)), pa.array(at)],
                                ["shard", "source_no", "pass", "block"])

        before = F.sum("drawn").over(Window.partitionBy("source_no").orderBy("shard")) - F.col("drawn")
        return draws.select("shard", "source_no", before.alias("first"), "drawn").mapInArrow(place, out)

    def documents(self) -> DataFrame:
        """One row per row of docs: source_no, doc_id, text_hash, size, start (its first word's place
        in its source) and the source's size, target and block_words."""
        buckets = -(-self.n_units // BUCKET_ROWS)
        words = F.col("size") * F.col("copies")
        units = (self.units.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(max(1, buckets))))
                 .join(self.sources(), F.col("source").eqNullSafe(F.col("name"))))
        per_bucket = units.groupBy("source_no", "bucket").agg(F.sum(words).alias("words"))
        base = per_bucket.select("source_no", "bucket", (F.sum("words").over(
            Window.partitionBy("source_no").orderBy("bucket")) - F.col("words")).alias("base"))
        order = Window.partitionBy("source_no", "bucket").orderBy("doc_id", "text_hash", "size", "part")
        laid = units.withColumn("inner", F.sum(words).over(order) - words).join(base, ["source_no", "bucket"])
        copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
        return laid.select("*", copy).select(
            "source_no", "doc_id", "text_hash", "size", "source_size", "target", "block_words",
            (F.col("base") + F.col("inner") + F.col("copy") * F.col("size")).alias("start"))

    def overlaps(self, documents: DataFrame) -> DataFrame:
        """Documents of one word or more, one row per block they touch, with the words in it."""
        b, start, end = F.col("block_words"), F.col("start"), F.col("start") + F.col("size")
        touched = F.sequence(F.expr("start div block_words"), F.expr("(start + size - 1) div block_words"))
        low, high = F.greatest(start, F.col("block") * b), F.least(end, (F.col("block") + 1) * b)
        return (documents.filter("size > 0").select("*", F.explode(touched).alias("block"))
                .withColumn("from", low - start).withColumn("to", high - start))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, size, source_size, target and taken (words that the mix takes, repeats counted)."""
    plan = Mix(docs, **settings)
    documents = plan.documents()
    times = plan.slots().groupBy("source_no", "block").agg(F.count("*").alias("times"))
    row = ["doc_id", "size", "source_size", "target"]
    taken = (plan.overlaps(documents).join(times.hint("merge"), ["source_no", "block"], "left")
             .groupBy("source_no", "start", *row)
             .agg(F.sum((F.col("to") - F.col("from")) * F.coalesce("times", F.lit(0))).cast("long").alias("taken")))
    empty = documents.filter("size = 0").select(*row, F.lit(0).cast("long").alias("taken"))
    return taken.select(*row, "taken").union(empty)


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix as rows with the columns of ``docs``: for every pass that takes words of a document,
    one row with the words taken (runs of words as they stand in the text, joined by a line end)
    and its n_chars. A document that is taken whole keeps its text as it is."""
    plan = Mix(docs, **settings)
    ranges = (plan.overlaps(plan.documents()).join(plan.slots().hint("merge"), ["source_no", "block"])
              .groupBy("source_no", "start", "pass", "doc_id", "text_hash", "size")
              .agg(F.array_sort(F.collect_list(F.struct("from", "to"))).alias("ranges")))
    names = plan.sources().select("source_no", F.col("name").alias("source"))
    key = F.struct("source", "doc_id", "text_hash").alias("key")
    wanted = ranges.join(names, "source_no").select(key, "size", "ranges")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    whole = docs.select(F.struct(F.col("source").cast("string").alias("source"),
                                 F.col("doc_id").cast("long").alias("doc_id"),
                                 F.xxhash64("text").alias("text_hash")).alias("key"), row.alias("row"))
    repeated = stage_table(plan.units.groupBy(F.struct("source", "doc_id", "text_hash").alias("key"))
                           .agg(F.sum("copies").alias("n")).filter("n > 1").select("key"), "mix_repeated")
    # texts stream past the ranges of a key that occurs once (at most MAX_REPEATS of them) unsorted;
    # a key that repeats may have any number of ranges, so it is aggregated and merged
    if repeated.isEmpty():
        met = wanted.hint("shuffle_hash").join(whole, "key")
    else:
        one = (whole.join(repeated, "key", "left_semi").groupBy("key")
               .agg(smallest_row(docs, "row").alias("row")))
        met = (wanted.join(repeated, "key", "left_anti").hint("shuffle_hash")
               .join(whole.join(repeated, "key", "left_anti"), "key")
               .union(wanted.join(repeated, "key", "left_semi").hint("merge").join(one, "key")))

    @F.arrow_udf("string")
    def cut(texts: pa.Array, sizes: pa.Array, ranges: pa.Array) -> pa.Array:
        out = pa.array([cut_words(t.as_py(), n.as_py(), r.as_py()) for t, n, r in
                        zip(texts, sizes, ranges, strict=True)], pa.string())
        give_back()
        return out

    taken = met.select("row", cut(F.col("row.text"), F.col("size"), F.col("ranges")).alias("cut"))
    new = {"text": F.col("cut"), "n_chars": F.length("cut").cast("long")}
    return taken.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def cut_words(text: str, size: int, ranges: list[dict]) -> str:
    """The words of sorted, disjoint ranges; ranges that touch are one run."""
    import re

    runs: list[list[int]] = []
    for r in ranges:
        if runs and runs[-1][1] == r["from"]:
            runs[-1][1] = r["to"]
        else:
            runs.append([r["from"], r["to"]])
    if runs == [[0, size]]:
        return text
    at = [m.span() for m in re.finditer(WORD, text)]
    return "\n".join(text[at[a][0]:at[b - 1][1]] for a, b in runs)


@register("op3_mixing")
def op3_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))
