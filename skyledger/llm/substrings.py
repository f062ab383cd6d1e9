"""Exact removal of repeated substrings with suffix arrays.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts in a document with
a smaller doc_id. Texts are UTF-8 bytes; matches never cross documents and are judged on
the input.

Candidates. The anchor of a window is its GRAM-byte string with the smallest hash (the
leftmost on ties), so equal windows have equal anchors at equal places. The windows that
share one anchor occurrence are a region, at most ``2 * WINDOW - GRAM`` bytes long. A
first pass finds the anchors that occur in more than one document; only their regions go
on. This drops nothing that could match.

Matching. Regions are routed by anchor. Equal regions are made one (with their smallest
doc_id) in every part before the shuffle and again after it. The different regions of an
anchor are cut to what each shares with another one around the anchor (a longer match is
impossible, and one shorter than a window is none). They are laid, with the anchor itself
as one symbol, into a text whose suffix array is built by linear grouping
(``grouping.suffix_array``); neighbours in it whose first symbols span a window are equal
windows, and a run of them shares its smallest doc_id.

Work is laid out in parts of about ``PART_BYTES``, stored as a table bucketed by part, so
three passes over the texts need no further shuffle of them; what travels is packed
arrays of anchors, regions and answers. A part sends an anchor once, with its count if it
has it more than once. An anchor with more than ``HOT`` occurrences is cut: its regions become single
windows, which are routed by their own hash instead, so a very common passage is spread
and still exact.

Defined results: a null text is empty; a text shorter than a window keeps all its bytes;
rows with a null doc_id neither lose bytes nor cause removals; rows that repeat a doc_id
do not affect each other (their ids are equal, not smaller); extra columns are ignored;
an empty table gives no rows. Anchor and window routing keys are 64-bit hashes; they
decide where regions meet, and the bytes decide what is equal.
"""

from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.grouping import suffix_array
from skyledger.llm.registry import register, table
from skyledger.session import remove_path, scratch_path, ship_package, stage_table, storage_root

WINDOW, GRAM = 50, 24
REST = WINDOW - GRAM  # a window is its anchor and so many more bytes
PART_BYTES = 8 << 20
BLOCK = 1 << 17
BUCKET_ANCHORS = 1 << 19
HOT = 4096
RANGE_REGIONS = 1 << 14  # of a bucket, searched at a time; equal keys stay together
TEXT_SYMBOLS = 1 << 15  # of one suffix array; an anchor's regions stay together
NOBODY = np.iinfo(np.int64).max

_MULTIPLY = 0x9E3779B97F4A7C15
_LOW = (1 << 20) - 1
MESSAGE = "part int, bucket int, kind int, a binary, b binary, c binary, d binary, e binary"
MASKS, ANSWERS = 0, 1


# ---------------------------------------------------------------- anchors
class _Powers:
    """Random word per byte, and powers of an odd multiplier and of its inverse modulo 2^64."""

    def __init__(self):
        rng = np.random.Generator(np.random.Philox(key=[50, 24]))
        self.byte = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up, self.down = (self._row(x) for x in (_MULTIPLY, pow(_MULTIPLY, -1, 1 << 64)))

    @staticmethod
    def _row(x):
        row = np.full(BLOCK + 2 * WINDOW, x, dtype=np.uint64)
        row[0] = 1
        return np.cumprod(row, dtype=np.uint64)


_POWERS: list[_Powers] = []


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def gram_hashes(x: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` bytes of a block, by differences of one running sum."""
    if not _POWERS:
        _POWERS.append(_Powers())
    powers, n = _POWERS[0], len(x)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(powers.byte[x] * powers.up[:n], out=sums[1:])
    return _scramble((sums[size:] - sums[:-size]) * powers.down[:n - size + 1])


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        v = np.minimum(v[:-done], v[done:])
        done *= 2
    return np.minimum(v[:len(v) - (width - done)], v[width - done:]) if done < width else v


def _blocks(texts):
    """Blocks of whole texts, or of segments of a long one that overlap by a window less a byte:
    (text number, place in the text, bytes)."""
    block, size = [], 0
    for d, raw in enumerate(texts):
        if len(raw) < WINDOW:
            continue
        for at in range(0, len(raw) - WINDOW + 1, BLOCK):
            piece = raw[at:at + BLOCK + WINDOW - 1]
            if size and size + len(piece) > BLOCK:
                yield block
                block, size = [], 0
            block.append((d, at, piece))
            size += len(piece)
    if block:
        yield block


def regions(texts):
    """Arrays (text, first window, last window, anchor's place, anchor's hash), one entry per
    anchor occurrence, in order of text and place."""
    out = [[np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]]
    for block in _blocks(texts):
        x = np.frombuffer(b"".join(p for _, _, p in block), dtype=np.uint8)
        size = np.array([len(p) for _, _, p in block])
        begin = np.cumsum(size) - size
        text = np.array([d for d, _, _ in block])
        shift = np.array([a for _, a, _ in block]) - begin
        hashes = gram_hashes(x, GRAM)
        ranked = (hashes & ~np.uint64(_LOW)) | np.arange(len(hashes), dtype=np.uint64)
        anchor = (_sliding_min(ranked, REST + 1) & np.uint64(_LOW)).astype(np.int64)
        inside = np.zeros(len(x) + 1, dtype=np.int8)
        inside[begin] += 1
        inside[begin + size - WINDOW + 1] -= 1
        window = np.nonzero(np.cumsum(inside[:len(anchor)]))[0]
        at = anchor[window]
        first = np.concatenate([[True], at[1:] != at[:-1]])
        owner = np.searchsorted(begin, window[first], side="right") - 1
        last = window[np.append(np.nonzero(first)[0][1:], len(at)) - 1]
        move = shift[owner]
        # anchors have small hashes by their nature; scrambled once more, they spread over all buckets
        out.append([text[owner], window[first] + move, last + move, at[first] + move,
                    _scramble(hashes[at[first]] * np.uint64(_MULTIPLY))])
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def _unpack(column, dtype):
    return [np.frombuffer(b.as_py(), dtype) for b in column]


def _texts(part: pa.Table):
    return part.column("doc_id").to_numpy(), [t.as_py() or b"" for t in part.column("raw")]


def _message(rows) -> pa.Table:
    kinds = [pa.int32()] * 3 + [pa.binary()] * 5
    names = [c.split()[0] for c in MESSAGE.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * 8
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _by_bucket(keys: np.ndarray, bits: int):
    """(bucket, from, to) of every bucket that sorted 64-bit keys touch."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    edge = np.nonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))[0] if len(keys) else []
    for a, b in zip(edge, [*edge[1:], len(keys)], strict=True):
        yield int(bucket[a]), int(a), int(b)


# ------------------------------------------------- pass 1: shared anchors
def send_anchors(part: pa.Table, bits: int) -> pa.Table:
    """A part's distinct anchors in order, and the counts of those it has more than once."""
    number = part.column("part")[0].as_py()
    keys, count = np.unique(regions(_texts(part)[1])[4], return_counts=True)
    rows = []
    for bucket, a, b in _by_bucket(keys, bits):
        many = np.nonzero(count[a:b] > 1)[0]
        rows.append((number, bucket, 0, keys[a:b].tobytes(), many.astype(np.int32).tobytes(),
                     count[a:b][many].astype(np.int32).tobytes(), None, None))
    return _message(rows)


def answer_anchors(bucket: pa.Table, hot_above: int) -> pa.Table:
    """For every part of a bucket: which of its anchors other parts have too, and which are hot."""
    keys = _unpack(bucket.column("a"), np.uint64)
    weight = [np.ones(len(k), dtype=np.int64) for k in keys]
    for w, at, n in zip(weight, _unpack(bucket.column("b"), np.int32), _unpack(bucket.column("c"), np.int32),
                        strict=True):
        w[at] = n
    _, inverse, parts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    total = np.bincount(inverse, weights=np.concatenate(weight))
    shared, hot = parts[inverse] > 1, total[inverse] > hot_above
    rows, at = [], 0
    for part, number, k in zip(bucket.column("part").to_pylist(), bucket.column("bucket").to_pylist(), keys,
                               strict=True):
        span = slice(at, at + len(k))
        at += len(k)
        rows.append((part, number, MASKS, np.packbits(shared[span]).tobytes(), np.packbits(hot[span]).tobytes(),
                     np.int64(len(k)).tobytes(), None, None))
    return _message(rows)


# --------------------------------------------------------- pass 2: regions
class PartRegions:
    """The regions of a part whose anchors several documents share. ``owner`` has the entry of
    each occurrence; an entry is one distinct region: key, place of its anchor, windows after the
    first, smallest doc_id, bytes. Entries are in order of key."""

    def __init__(self, ids, texts, masks: pa.Table):
        text, low, high, at, key = regions(texts)
        masks = masks.filter(pa.compute.equal(masks.column("kind"), MASKS)).sort_by("bucket")
        sizes = [int(n[0]) for n in _unpack(masks.column("c"), np.int64)]
        shared, hot = (np.concatenate([np.unpackbits(m, count=n) for m, n in
                                       zip(_unpack(masks.column(c), np.uint8), sizes, strict=True)]
                                      + [np.zeros(0, np.uint8)]).astype(bool) for c in "ab")
        keys, inverse = np.unique(key, return_inverse=True)
        doc = ids[text] if len(text) else np.zeros(0, np.int64)
        if len(keys):
            least, most = np.full(len(keys), NOBODY), np.full(len(keys), np.iinfo(np.int64).min)
            np.minimum.at(least, inverse, doc)
            np.maximum.at(most, inverse, doc)
            shared |= least != most
        take = shared[inverse]
        cut = take & hot[inverse]
        take &= ~cut
        occurrence = [text[take], low[take], high[take], at[take] - low[take], key[take]]
        if cut.any():  # regions of hot anchors become single windows with keys of their own
            n = high[cut] - low[cut] + 1
            t = np.repeat(text[cut], n)
            s = np.repeat(low[cut] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            gram = np.repeat(at[cut], n) - s
            own = np.array([int.from_bytes(hashlib.blake2b(texts[a][b:b + WINDOW], digest_size=8).digest(), "little")
                            for a, b in zip(t.tolist(), s.tolist())], dtype=np.uint64)
            occurrence = [np.concatenate(p) for p in zip(occurrence, [t, s, s, gram, own], strict=True)]
        self.text, self.low, self.high, place, key = occurrence
        self.doc = ids[self.text] if len(self.text) else np.zeros(0, np.int64)
        more = self.high - self.low
        order = np.lexsort((more, place, key))
        # regions can be equal only if key, place and length are; then the bytes decide
        k, p, m = key[order], place[order], more[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (k[1:] != k[:-1]) | (p[1:] != p[:-1]) | (m[1:] != m[:-1])
        group = np.cumsum(new) - 1
        kind = np.zeros(len(order), dtype=np.int64)
        here, known = -1, {}
        for j in np.nonzero(np.bincount(group)[group] > 1)[0].tolist() if len(group) else []:
            if group[j] != here:
                here, known = group[j], {}
            i = order[j]
            kind[j] = known.setdefault(texts[self.text[i]][self.low[i]:self.high[i] + WINDOW], len(known))
        _, first, entry = np.unique(group * (kind.max(initial=0) + 1) + kind, return_index=True, return_inverse=True)
        self.first = order[first]
        self.owner = np.empty(len(order), dtype=np.int64)
        self.owner[order] = entry
        self.key, self.place, self.more = key[self.first], place[self.first], more[self.first]
        self.least = np.full(len(self.first), NOBODY)
        np.minimum.at(self.least, self.owner, self.doc)
        self.texts = texts

    def bytes(self, a: int, b: int) -> bytes:
        """The regions of the entries from ``a`` to ``b``, end to end."""
        some = self.first[a:b]
        return b"".join([self.texts[t][x:y + WINDOW] for t, x, y in zip(
            self.text[some].tolist(), self.low[some].tolist(), self.high[some].tolist(), strict=True)])


def send_regions(part: pa.Table, masks: pa.Table, bits: int) -> pa.Table:
    if not len(part):
        return _message([])
    r = PartRegions(*_texts(part), masks)
    number = part.column("part")[0].as_py()
    return _message([(number, bucket, 0, r.key[a:b].tobytes(), r.place[a:b].astype(np.uint8).tobytes(),
                      r.more[a:b].astype(np.uint8).tobytes(), r.least[a:b].tobytes(), r.bytes(a, b))
                     for bucket, a, b in _by_bucket(r.key, bits)])


def smallest_docs(group: list[tuple[bytes, int, int]]) -> list[np.ndarray]:
    """For distinct regions (bytes, place of the anchor, smallest doc_id) of several anchors, given
    as lists per anchor: for each region the smallest doc_id of every window, by suffix array."""
    text, doc, spans = [], [], []
    for symbol, members in enumerate(group):
        for raw, place, least in members:
            windows = len(raw) - WINDOW + 1
            spans.append((len(text), windows))
            text += [b + 1 for b in raw[:place]]
            text.append(257 + symbol)
            text += [b + 1 for b in raw[place + GRAM:]]
            text.append(0)
            doc += [least] * windows + [NOBODY] * (len(text) - len(doc) - windows)
    order = np.array(suffix_array(text))
    symbols = np.array(text + [0] * (REST + 1))
    windows = np.lib.stride_tricks.sliding_window_view(symbols, REST + 1)[order]
    doc = np.array(doc)[order]
    usable = doc != NOBODY
    order, windows, doc = order[usable], windows[usable], doc[usable]
    edge = np.nonzero(np.concatenate([[True], (windows[1:] != windows[:-1]).any(axis=1)]))[0]
    least = np.minimum.reduceat(doc, edge)
    out = np.full(len(text), NOBODY)
    out[order] = np.repeat(least, np.diff(np.append(edge, len(doc))))
    return [out[a:a + n] for a, n in spans]


def _longest_shared(texts: list[bytes]) -> list[int]:
    """Length of the longest prefix that each text shares with any other of the list."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    out = [0] * len(texts)
    for i, j in zip(order, order[1:]):
        a, b = texts[i], texts[j]
        n = min(len(a), len(b))
        if a[:n] != b[:n]:
            n = next(x for x in range(n) if a[x] != b[x])
        out[i], out[j] = max(out[i], n), n
    return out


def trimmed(members: list[tuple[bytes, int]]) -> list[tuple[int, bytes, int] | None]:
    """For the different regions (bytes, place of the anchor) of one anchor: each one cut to what
    it shares with some other on the left and on the right of the anchor, as (bytes cut off in
    front, bytes, place); None if that holds no window. Longer matches there are not."""
    left = _longest_shared([raw[:place][::-1] for raw, place in members])
    right = _longest_shared([raw[place + GRAM:] for raw, place in members])
    return [(place - x, raw[place - x:place + GRAM + y], x) if x + y >= REST else None
            for (raw, place), x, y in zip(members, left, right, strict=True)]


def answer_regions(bucket: pa.Table) -> pa.Table:
    """For every part: runs of windows of its regions that a document smaller than the region's
    smallest in that part has too. The bucket's keys are searched in ranges, one after another."""
    bucket = bucket.sort_by("part")
    blobs = list(zip(*(_unpack(bucket.column(c), t) for c, t in
                       (("a", np.uint64), ("b", np.uint8), ("c", np.uint8), ("d", np.int64))),
                     [r.as_py() for r in bucket.column("e")], strict=True))
    size = sum(len(blob[0]) for blob in blobs)
    every = np.sort(np.concatenate([blob[0] for blob in blobs]))
    edges = np.unique(every[RANGE_REGIONS::RANGE_REGIONS]) if size > RANGE_REGIONS else every[:0]
    cuts = [np.concatenate([[0], np.searchsorted(blob[0], edges), [len(blob[0])]]) for blob in blobs]
    starts = [np.concatenate([[0], np.cumsum(blob[2].astype(np.int64) + WINDOW)]) for blob in blobs]
    out: list[list] = [[] for _ in blobs]
    for k in range(len(edges) + 1):
        _answer_range([(blob, start, int(cut[k]), int(cut[k + 1])) for blob, start, cut in
                       zip(blobs, starts, cuts, strict=True)], out)
    return _message([
        (part, number, ANSWERS, *(np.array([f[i] for f in found], t).tobytes() for i, t in
                                  enumerate((np.int32, np.uint8, np.uint8, np.int64))),
         np.int64(len(blob[0])).tobytes())
        for part, number, blob, found in zip(bucket.column("part").to_pylist(), bucket.column("bucket").to_pylist(),
                                             blobs, out, strict=True)])


def _answer_range(blobs, out) -> None:
    """Answers (entry, first window, last window, doc_id) of the entries from ``a`` to ``b`` of each blob."""
    merged: dict[int, dict[tuple, int]] = {}
    entries = []
    for (keys, places, _, least, raw), start, a, b in blobs:
        mine = []
        for key, place, doc, x, y in zip(keys[a:b].tolist(), places[a:b].tolist(), least[a:b].tolist(),
                                         start[a:b].tolist(), start[a + 1:b + 1].tolist(), strict=True):
            group = merged.get(key)
            if group is None:
                group = merged[key] = {}
            region = (raw[x:y], place)
            known = group.get(region)
            if known is None or doc < known:
                group[region] = doc
            mine.append((group, region, doc))
        entries.append(mine)
    answer: dict[int, dict[tuple, np.ndarray]] = {}  # by identity of the group
    batch, size = [], 0

    def solve():
        found = iter(smallest_docs([[(raw, place, doc) for _, _, raw, place, doc in members] for _, members in batch]))
        for group, members in batch:
            mine = answer[id(group)] = {}
            for region, front, _, _, doc in members:
                least = next(found)
                whole = mine[region] = np.full(len(region[0]) - WINDOW + 1, doc)
                whole[front:front + len(least)] = least

    for group in merged.values():
        if len(group) > 1:
            cut = trimmed(list(group))
            members = [(region, *c, doc) for (region, doc), c in zip(group.items(), cut, strict=True) if c]
            if members:
                batch.append((group, members))
                size += sum(len(m[2]) for m in members)
                if size > TEXT_SYMBOLS:
                    solve()
                    batch, size = [], 0
    if batch:
        solve()
    for (_, _, a, _), mine, found in zip(blobs, entries, out, strict=True):
        for e, (group, region, own) in enumerate(mine, a):
            docs = answer.get(id(group), group)
            docs = docs.get(region) if docs is not group else None
            if docs is None:
                doc = group[region]
                if doc < own:
                    found.append((e, 0, len(region[0]) - WINDOW, doc))
            elif docs.min() < own:
                edge = [0, *(np.nonzero(docs[1:] != docs[:-1])[0] + 1).tolist(), len(docs)]
                found += [(e, i, j - 1, int(docs[i])) for i, j in zip(edge, edge[1:]) if docs[i] < own]


# ------------------------------------------------------- pass 3: removal
RESULT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
          "removed array<struct<start:bigint,end:bigint>>, kept binary")


def remove(part: pa.Table, messages: pa.Table, with_text: bool) -> pa.Table:
    kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                                pa.binary()]
    names = [c.split()[0] for c in RESULT.split(", ")]
    if not len(part):
        return pa.table([pa.array([], k) for k in kinds], names=names)
    ids, texts = _texts(part)
    r = PartRegions(ids, texts, messages)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.cumsum(size) - size
    cover = np.zeros(int(size.sum()) + 1, dtype=np.int32)

    def mark(text, low, high):
        np.add.at(cover, begin[text] + low, 1)
        np.add.at(cover, begin[text] + high + WINDOW, -1)

    later = r.doc > r.least[r.owner] if len(r.owner) else np.zeros(0, bool)
    mark(r.text[later], r.low[later], r.high[later])
    answers = messages.filter(pa.compute.equal(messages.column("kind"), ANSWERS)).sort_by("bucket")
    if len(answers):
        counts = np.array([int(n[0]) for n in _unpack(answers.column("e"), np.int64)])
        first = np.cumsum(counts) - counts
        entry = np.concatenate([e + f for e, f in zip(_unpack(answers.column("a"), np.int32), first, strict=True)])
        low, high, doc = (np.concatenate(_unpack(answers.column(c), t)) for c, t in
                          (("b", np.uint8), ("c", np.uint8), ("d", np.int64)))
        order = np.argsort(r.owner, kind="stable")  # occurrences of each entry
        start = np.searchsorted(r.owner[order], entry)
        n = np.searchsorted(r.owner[order], entry, side="right") - start
        run = np.repeat(np.arange(len(entry)), n)
        hit = order[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        smaller = doc[run] < r.doc[hit]
        run, hit = run[smaller], hit[smaller]
        mark(r.text[hit], r.low[hit] + low[run], r.low[hit] + high[run])
    gone = np.cumsum(cover)[:-1] > 0
    rows = []
    for doc, raw, a in zip(ids.tolist(), texts, begin.tolist(), strict=True):
        mine = gone[a:a + len(raw)]
        edge = np.diff(np.concatenate([[0], mine.view(np.int8), [0]]))
        spans = list(zip(np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == -1)[0].tolist(), strict=True))
        kept = np.frombuffer(raw, np.uint8)[~mine].tobytes() if spans else raw
        rows.append((doc, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                     [{"start": s, "end": e} for s, e in spans], kept if with_text else None))
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


# --------------------------------------------------------------- operator
def dedup_substrings(docs: DataFrame, with_text: bool = False, part_bytes: int = PART_BYTES,
                     hot_above: int = HOT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_bytes, n_removed, n_spans, kept_sha256, the
    ``removed`` byte ranges, and the ``kept`` bytes if asked for."""
    spark = docs.sparkSession
    ship_package(spark)
    storage_root(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"))
    total = rows.agg(F.sum(F.length("raw"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    bits = max(0, math.ceil(math.log2(max(1, total / (REST / 2 + 1) / BUCKET_ANCHORS))))
    name, path = f"llm_parts_{uuid.uuid4().hex}", scratch_path(spark, "parts")
    # rows are dealt by position, so no doc_id, text or source decides where a row goes
    (rows.filter("doc_id is not null")
     .withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int"))
     .repartition(parts, "part").write.option("path", path).bucketBy(parts, "part").saveAsTable(name))
    stored = spark.table(name)

    anchors = stored.groupBy("part").applyInArrow(lambda t: send_anchors(t, bits), MESSAGE)
    masks = stage_table(anchors.groupBy("bucket").applyInArrow(lambda t: answer_anchors(t, hot_above), MESSAGE), "substring_masks")
    sent = (stored.groupBy("part").cogroup(masks.groupBy("part"))
            .applyInArrow(lambda t, m: send_regions(t, m, bits), MESSAGE))
    answers = stage_table(sent.groupBy("bucket").applyInArrow(answer_regions, MESSAGE), "substring_answers")
    result = (stored.groupBy("part").cogroup(masks.union(answers).groupBy("part"))
              .applyInArrow(lambda t, m: remove(t, m, with_text), RESULT))
    result = stage_table(result, "substring_result")
    spark.sql(f"DROP TABLE {name}")
    remove_path(spark, path)

    size = F.length("raw").cast("long")
    unnamed = rows.filter("doc_id is null").select(
        "doc_id", size.alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("raw", 256).alias("kept_sha256"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("removed"),
        (F.col("raw") if with_text else F.lit(None).cast("binary")).alias("kept"))
    return result.union(unnamed)


@register("op10_suffix_dedup")
def op10_suffix_dedup(spark, sf_dir):
    return dedup_substrings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
