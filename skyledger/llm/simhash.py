"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprint: words are lower-cased (A-Z) runs without ASCII white space; every run of
``shingle`` words, space-joined, is hashed with XXH64 (seed 42); bit i of the
fingerprint is set if it is set in more than half of the hashes. Texts with fewer words
have one shingle, texts without words fingerprint zero.

Candidates: the 64 bits form three segments of 22, 21 and 21 bits, read as words of the
perfect binary Golay code of length 23. The keys of a segment are the indices of the
codewords nearest to it and to its one-bit neighbours. Two values at most 2 bits apart
have a common neighbour within one bit of both, hence a common key. For a pair at most
4 bits apart, by the pigeonhole principle:

* some segment has no error, and the better of the other two has at most 2: they share
  (exact segment, key of the other);
* or every segment has an error, so two have one each and the third at most 2: those two
  each have an exact half, and they share (exact half, exact half, key of the third).

Either way a shared key has about 34 bits, so chance meetings stay rare however many
fingerprints there are. Fingerprints are made distinct first, so groups of copies cost
one row. Keys are counted first (with partial counts before the shuffle), and only the
few that two fingerprints share go on. Each is searched breadth-first from unvisited
members, which finds every member's component without listing the pairs of a group. A
key with very many fingerprints is cut into chunks, and every pair of chunks is searched
on its own. Distances are always verified.

Defined results: a null text counts as empty; repeated rows are returned once each; a
null doc_id never becomes a component_id (a component of null ids only has null); extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.components import components
from skyledger.llm.registry import register, table
from skyledger.operators.sizing import bounded_broadcast
from skyledger.session import ship_package, stage_table

SEED = 42
MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, width
CHUNK = 2048  # fingerprints of one key searched together
PRINTS_PER_TASK = 8192
SHARED_BROADCAST_BYTES = 16 << 20  # beyond it the keys are joined by a shuffle
IDS_BROADCAST = 1_000_000  # ids that go; more of them meet the rows by a shuffle

# ----------------------------------------------------------- fingerprints
SLICE_WORDS = 1 << 18


def shingle_hashes(raw: bytes, shingle: int):
    """uint64 arrays of the hashes of all shingles, repeats included."""
    from xxhash import xxh64_intdigest

    words = raw.lower().split()
    if not words:
        return
    if len(words) < shingle:
        yield np.array([xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
        return
    for at in range(0, len(words) - shingle + 1, SLICE_WORDS):
        part = words[at:at + SLICE_WORDS + shingle - 1]
        text = b" ".join(part)
        size = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
        end = np.cumsum(size + 1) - 1
        yield np.array([xxh64_intdigest(text[a:b], SEED) for a, b in
                        zip((end - size).tolist(), end[shingle - 1:].tolist())], dtype=np.uint64)


def fingerprint_of(raw: bytes, shingle: int) -> int:
    ones, total = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(raw, shingle):
        for at in range(0, len(hashes), 1 << 16):
            block = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    bits = np.packbits(ones * 2 > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, shingle: int) -> Column:
    """64-bit SimHash of a text column as a (signed) bigint."""
    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        raw = texts.cast(pa.binary())
        return pa.array([fingerprint_of(t.as_py() or b"", shingle) for t in raw], pa.int64())

    return simhash(text)


# ------------------------------------------------------------------ Golay
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


class Golay:
    """Nearest codewords of the perfect [23, 12, 7] code, for arrays of 23-bit words."""

    def __init__(self):
        unit = [_remainder(1 << b) for b in range(23)]
        self.leader = np.zeros(2048, dtype=np.int64)  # error of up to 3 bits by syndrome
        for a in range(23):
            self.leader[unit[a]] = 1 << a
            for b in range(a):
                self.leader[unit[a] ^ unit[b]] = 1 << a | 1 << b
                for c in range(b):
                    self.leader[unit[a] ^ unit[b] ^ unit[c]] = 1 << a | 1 << b | 1 << c
        self.syndrome = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 11, dtype=np.int64)
        for half, first in ((self.syndrome[0], 0), (self.syndrome[1], 12)):
            for bit in range(half.size.bit_length() - 1):
                half[1 << bit:2 << bit] = half[:1 << bit] ^ unit[first + bit]

    def index(self, words: np.ndarray) -> np.ndarray:
        """Index (0 to 4095) of the codeword nearest to each word."""
        syndrome = self.syndrome[0][words & 0xFFF] ^ self.syndrome[1][words >> 12]
        return (words ^ self.leader[syndrome]) >> 11

    def keys(self, words: np.ndarray, width: int) -> np.ndarray:
        """Per word the sorted indices of it and its one-bit neighbours; repeats are -1."""
        flips = np.concatenate(([0], 1 << np.arange(width, dtype=np.int64)))
        out = np.sort(self.index(words[:, None] ^ flips), axis=1)
        out[:, 1:][out[:, 1:] == out[:, :-1]] = -1
        return out


def fuzzy_keys(prints: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(key, position of its fingerprint) of every fingerprint."""
    u = prints.view(np.uint64)
    segment = [((u >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64)
               for first, width in SEGMENTS]
    halves = [(s & ((1 << w // 2) - 1), s >> (w // 2)) for s, (_, w) in zip(segment, SEGMENTS, strict=True)]
    keys, at, tag = [], [], 0
    for c in range(3):
        index = golay.keys(segment[c], SEGMENTS[c][1])
        used = index >= 0
        rows = np.nonzero(used)[0]
        a, b = (s for s in range(3) if s != c)
        exact = [segment[a], segment[b]] + [x << 11 | y for x in halves[a] for y in halves[b]]
        for value in exact:
            keys.append((tag << 40) | (value[rows] << 12) | index[used])
            at.append(rows)
            tag += 1
    return np.concatenate(keys), np.concatenate(at)


# ------------------------------------------------------------------ links
def local_roots(prints: np.ndarray, max_bits: int) -> np.ndarray:
    """Smallest fingerprint of each one's component under links of up to ``max_bits``."""
    root, bits = prints.copy(), prints.view(np.uint64)  # a bit count needs unsigned words
    left = np.argsort(prints, kind="stable")
    while len(left):
        first, left = left[0], left[1:]
        frontier = np.array([first])
        while len(frontier) and len(left):
            near = np.zeros(len(left), dtype=bool)
            for at in range(0, len(frontier), 64):
                some = frontier[at:at + 64]
                rest = np.nonzero(~near)[0]
                apart = np.bitwise_count(bits[some][:, None] ^ bits[left[rest]][None, :])
                near[rest[(apart <= max_bits).any(axis=0)]] = True
            frontier, left = left[near], left[~near]
            root[frontier] = prints[first]
    return root


def _search(batches, max_bits: int):
    """Rows (key, lo, hi, fp) sorted by the first three -> (fp, root) of linked fingerprints."""
    held: list[np.ndarray] = []

    def solve(rows):
        out = []
        edge = np.nonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1))[0] + 1
        for group in np.split(np.ascontiguousarray(rows[:, 3]), edge):
            root = local_roots(group, max_bits)
            linked = root != group
            out.append(np.stack([group[linked], root[linked]], axis=1))
        found = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["u", "v"])

    for batch in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
        if not len(rows):
            continue
        last = (rows[:, :3] != rows[-1, :3]).any(axis=1)
        begin = int(np.nonzero(last)[0][-1]) + 1 if last.any() else 0
        if held and (held[-1][-1, :3] != rows[0, :3]).any():
            yield solve(np.concatenate(held))
            held = []
        if begin:
            yield solve(np.concatenate([*held, rows[:begin]]))
            held = []
        held.append(rows[begin:])
    if held:
        yield solve(np.concatenate(held))


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) that connect distinct fingerprints (column ``fp``) exactly as all pairs of up
    to ``max_bits`` differing bits do; every edge lies within one component."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be from 0 to {MAX_BITS}")

    def emit(batches):
        golay = Golay()
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for start in range(0, len(fp), 4096):
                part = fp[start:start + 4096]
                key, at = fuzzy_keys(part, golay)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[at])], ["key", "fp"])

    # many tasks: every row becomes about a hundred keys
    prints = stage_table(prints.select("fp"), "simhash_prints")
    tasks = max(1, -(-prints.count() // PRINTS_PER_TASK))
    keys = prints.repartition(tasks).mapInArrow(emit, "key long, fp long")
    shared = stage_table(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "simhash_keys")
    shared = shared.select("key", F.ceil(F.col("n") / CHUNK).cast("int").alias("parts"))
    chunk = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(
        F.least(F.col("chunk"), j).alias("lo"), F.greatest(F.col("chunk"), j).alias("hi")))
    side = bounded_broadcast(shared, SHARED_BROADCAST_BYTES)
    if side is shared:  # keys come from a smaller table, so the planner would think them small
        side = shared.hint("merge")
    members = (keys.join(side, "key").withColumn("chunk", chunk)
               .select("key", "fp", F.inline(cells)).select("key", "lo", "hi", "fp"))
    return (members.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
            .mapInArrow(lambda batches: _search(batches, max_bits), "u long, v long").distinct())


def classes(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of (doc_id, fp): root is the smallest
    fingerprint of the component, component_id its smallest doc_id."""
    prints = fingerprints.groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    roots = components(links(prints, max_bits)).withColumnRenamed("node", "fp")
    rooted = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    return rooted.join(first, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``."""
    ship_package(docs.sparkSession)
    prints = stage_table(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                     fingerprint(F.col("text"), shingle).alias("fp")), "simhash")
    return prints.join(classes(prints, max_bits), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_component(docs: DataFrame, shingle: int = 4, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the one whose doc_id names the component (of rows
    that repeat this doc_id, the smallest; columns without an order compare as JSON). All columns
    stay.

    Rows are decided as (doc_id, fingerprint); whole rows meet only the list of ids that go, by an
    anti-join. A doc_id that several rows have (null counts as one) cannot decide alone: where such
    a row may stay, its fingerprint says which component it is of.
    """
    ship_package(docs.sparkSession)
    prints = stage_table(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                     fingerprint(F.col("text"), shingle).alias("fp")), "simhash")
    found = stage_table(classes(prints, max_bits), "simhash_classes")
    named = F.col("doc_id").eqNullSafe(F.col("component_id"))
    several = F.col("doc_id").isNull() | (F.col("n") > 1)
    listed = stage_table(
        prints.join(found, "fp").groupBy("doc_id").agg(F.count("*").alias("n"), F.max(named).alias("named"))
        .filter(several | ~F.col("named"))
        .select("doc_id", (several & F.col("named")).alias("again")), "simhash_ids")
    gone = listed.filter("doc_id is not null").select("doc_id")
    if gone.count() <= IDS_BROADCAST:
        gone = F.broadcast(gone)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row)
    kept = rows.filter("doc_id is not null").join(gone, "doc_id", "left_anti").select("row.*")
    again = listed.filter("again").select(F.col("doc_id").alias("id"))
    if again.isEmpty():
        return kept
    rest = (rows.join(again, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
            .select("doc_id", "row", fingerprint(F.col("row.text"), shingle).alias("fp"))
            .join(found, "fp").filter(named))
    return kept.union(rest.groupBy("root").agg(smallest_row(docs, "row").alias("row")).select("row.*"))


def smallest_row(docs: DataFrame, row: str) -> Column:
    """The smallest struct ``row`` of all columns of ``docs``; maps, which have no order, as JSON."""
    def key(f):
        value = F.col(row)[f.name]
        return F.to_json(F.struct(value)) if "map<" in f.dataType.simpleString() else value

    if all("map<" not in f.dataType.simpleString() for f in docs.schema.fields):
        return F.min(row)
    return F.min_by(row, F.struct(*[key(f).alias(f"k{i}") for i, f in enumerate(docs.schema.fields)]))


@register("op6_simhash_golay")
def op6_simhash_golay(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
