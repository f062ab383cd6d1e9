"""Harmonic packing of token ids into sequences of a fixed capacity.

A document's ids (with an end id) are cut into pieces. A piece of length r belongs
to the reciprocal-capacity class i with ``capacity/(i+1) < r <= capacity/i``; a bin
of class i takes exactly i pieces, whatever documents they come from. So every
partition fills its own bins in one pass, with no exchange and no look at other
bins. Cutting keeps the classes tight: whole capacities are cut off first, and a
rest that would leave more than ``tolerance`` of its slot empty gives up a piece of
exactly ``capacity // (i+1)`` and goes on with what is left.

Bins that are still open when a partition ends (at most one per class, so a bounded
number of ids) are laid end to end and cut into full sequences; what remains is
dealt to sequences whose lengths are powers of two, which need no padding.

Defined results: a null or empty text has the end id only; repeated rows are packed
once each; a null doc_id stays null; extra columns are ignored; an empty table gives
no rows. ``sequence_id`` is the partition number and a counter, so it is unique
without coordination.
"""

from __future__ import annotations

import struct
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.registry import register, table
from skyledger.llm.tokens import tokenizer
from skyledger.session import ship_package

CAPACITY = 4096
END_ID = 2
TOLERANCE = 256  # a slot may stay empty by one part in so many

_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
           "sequence_id long, offset long")


def pieces(n: int, capacity: int = CAPACITY, tolerance: int = TOLERANCE):
    """(length, class) of each piece of a document of n ids, in order."""
    while n >= capacity:
        yield capacity, 1
        n -= capacity
    while n:
        i = capacity // n
        slot = capacity // i
        if (slot - n) * tolerance <= slot:
            yield n, i
            return
        i += 1
        yield capacity // i, i
        n -= capacity // i


class Packer:
    """Bins of one partition. ``add`` takes a document's ids; ``rows`` collects finished pieces."""

    def __init__(self, first_sequence: int, capacity: int, tolerance: int, with_ids: bool):
        self.next, self.capacity, self.tolerance, self.with_ids = first_sequence, capacity, tolerance, with_ids
        self.open: dict[int, list] = {}
        self.rows: list[tuple] = []

    def _close(self, placed) -> None:
        offset = 0
        for doc, start, ids, total in placed:
            n = len(ids) // 4
            row = (doc, start, n, zlib.crc32(ids), total, self.next, offset)
            self.rows.append(row + (list(struct.unpack(f"<{n}I", ids)),) if self.with_ids else row)
            offset += n
        self.next += 1

    def add(self, doc, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        for length, kind in pieces(total, self.capacity, self.tolerance):
            piece = (doc, at, ids[4 * at:4 * (at + length)], total)
            at += length
            if kind == 1:
                self._close([piece])
                continue
            placed = self.open.setdefault(kind, [])
            placed.append(piece)
            if len(placed) == kind:
                self._close(self.open.pop(kind))

    def finish(self) -> None:
        left = [p for kind in sorted(self.open) for p in self.open[kind]]
        self.open = {}
        rest = sum(len(p[2]) // 4 for p in left)
        room, placed = 0, []
        for doc, start, ids, total in left:
            while ids:
                if not room:
                    room = self.capacity if rest >= self.capacity else 1 << (rest.bit_length() - 1)
                part, ids = ids[:4 * room], ids[4 * room:]
                placed.append((doc, start, part, total))
                start += len(part) // 4
                room -= len(part) // 4
                rest -= len(part) // 4
                if not room:
                    self._close(placed)
                    placed = []


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         tolerance: int = TOLERANCE, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ``ids``, the piece's token ids, if asked for). ``docs`` needs doc_id and text.
    ``capacity`` must be a power of two."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    ship_package(docs.sparkSession)
    schema = _SCHEMA + (", ids array<long>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64()] * 7 + ([pa.list_(pa.int64())] if with_ids else [])

    def run(batches):
        from pyspark import TaskContext

        tok, end = tokenizer(tokenizer_path), struct.pack("<I", end_id)
        packer = Packer(TaskContext.get().partitionId() << 33, capacity, tolerance, with_ids)

        def flush():
            columns = list(zip(*packer.rows, strict=True)) or [()] * len(names)
            packer.rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for doc, raw in zip(batch.column(0).to_pylist(), texts, strict=True):
                packer.add(doc, tok.ids(raw.as_py() or b"") + end)
                if len(packer.rows) >= 50_000:
                    yield flush()
            yield flush()
        packer.finish()
        yield flush()
        tok.forget()  # the worker may be kept for other stages

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, schema)


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register("op9_harmonic_packing")
def op9_harmonic_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), tokenizer_file())
