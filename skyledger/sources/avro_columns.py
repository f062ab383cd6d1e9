"""Avro records as columns: whole Arrow batches are encoded and decoded at a time.

Encoding lays the pieces of all rows (tags, lengths, values) one after another per column and
then puts each where its row has it. Decoding walks the blocks of a group side by side: step r
reads record r of every block that has one, a field of all blocks at a time, so blocks of any
writer do; of a few long blocks records are read one by one. Arrays and maps (and decimals too wide for 8 bytes) go value by value.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

FEW_BLOCKS, MANY_ROWS = 8, 4096
_WIDE = 18  # digits of a decimal that fit 8 bytes
_TENS = 10 ** np.arange(_WIDE + 1, dtype=np.int64)


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1, ... of all pieces, in order."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


# --------------------------------------------------------------- encoding
def _varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, bytes) of zigzag numbers."""
    left = ((values << 1) ^ (values >> 63)).view(np.uint64)
    lengths = np.ones(len(values), np.int64)
    for k in range(1, 10):
        more = left >= np.uint64(1 << 7 * k)
        if not more.any():
            break
        lengths += more
    width = int(lengths.max(initial=1))
    shifts = (7 * np.arange(width)).astype(np.uint64)
    out = ((left[:, None] >> shifts) & np.uint64(0x7F)).astype(np.uint8)
    at = np.arange(width)
    out[at < lengths[:, None] - 1] |= 0x80
    return lengths, out[at < lengths[:, None]]


def _texts(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    arr = arr.cast(pa.large_binary())
    _, offsets, data = arr.buffers()
    if not len(arr) or data is None:
        return np.zeros(len(arr), np.int64), np.zeros(0, np.uint8)
    ends = np.frombuffer(offsets, np.int64, len(arr) + 1, 8 * arr.offset)
    return np.diff(ends), np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]


def _decimals(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Big-endian two's complement of decimals of up to 18 digits."""
    n = np.frombuffer(arr.buffers()[1], np.int64, 2 * len(arr), 16 * arr.offset)[::2] if len(arr) else np.zeros(0, np.int64)
    size, lengths = np.abs(n), np.ones(len(n), np.int64)
    for k in range(1, 8):
        lengths += size >> (8 * k - 1) > 0
    at = np.arange(8)
    out = np.ascontiguousarray(n.astype(">i8")).view(np.uint8).reshape(-1, 8)
    return lengths, out[at >= 8 - lengths[:, None]]


def _pieces(arr: pa.Array, of: T.DataType, nullable: bool, live: np.ndarray, by_value) -> list[tuple[np.ndarray, np.ndarray]]:
    """(length per row, bytes) of a field's pieces; rows that are not live have none."""
    out = []
    valid = live & arr.is_valid().to_numpy(zero_copy_only=False)
    if nullable:
        out.append((live.astype(np.int64), np.where(valid, 2, 0).astype(np.uint8)[live]))
    elif (valid != live).any():
        raise ValueError("a null in a field that has none")
    if isinstance(of, T.StructType):
        for i, f in enumerate(of.fields):
            out += _pieces(arr.field(i), f.dataType, f.nullable, valid, by_value)
        return out

    def piece(lengths, data):
        whole = np.zeros(len(live), np.int64)
        whole[valid] = lengths
        out.append((whole, data))

    some = arr.filter(pa.array(valid))
    if isinstance(of, T.StringType | T.BinaryType):
        lengths, data = _texts(some)
        piece(*_varints(lengths))
        piece(lengths, data)
    elif isinstance(of, T.DecimalType) and of.precision <= _WIDE:
        lengths, data = _decimals(some.cast(pa.decimal128(of.precision, of.scale)))
        piece(*_varints(lengths))
        piece(lengths, data)
    elif isinstance(of, T.FloatType | T.DoubleType):
        kind = "<f4" if isinstance(of, T.FloatType) else "<f8"
        data = np.ascontiguousarray(some.to_numpy(zero_copy_only=False).astype(kind)).view(np.uint8)
        piece(int(kind[2]), data)
    elif isinstance(of, T.BooleanType):
        piece(1, some.to_numpy(zero_copy_only=False).astype(np.uint8))
    elif isinstance(of, T.ByteType | T.ShortType | T.IntegerType | T.LongType | T.DateType | T.TimestampType | T.TimestampNTZType):
        if isinstance(of, T.DateType):
            some = some.cast(pa.int32())
        piece(*_varints(some.cast(pa.int64()).to_numpy(zero_copy_only=False)))
    else:
        one = by_value(of)
        data = [one(v) for v in some.to_pylist()]
        piece(np.array([len(d) for d in data], np.int64), np.frombuffer(b"".join(data), np.uint8))
    return out


def encode(batch: pa.RecordBatch, of: T.StructType, by_value) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows, where each row ends). ``by_value``: a type's function from a value to bytes."""
    n, live, parts = batch.num_rows, np.ones(batch.num_rows, bool), []
    for i, f in enumerate(of.fields):
        parts += _pieces(batch.column(i), f.dataType, f.nullable, live, by_value)
    if not parts or not n:
        return np.zeros(0, np.uint8), np.zeros(n, np.int64)
    ends = np.cumsum(np.stack([p[0] for p in parts], axis=1), axis=None).reshape(n, len(parts))
    out = np.empty(ends[-1, -1], np.uint8)
    for k, (lengths, data) in enumerate(parts):
        starts = ends[:, k] - lengths
        if lengths.max() <= 1:
            out[starts[lengths > 0]] = data
        else:
            out[_spread(starts, lengths)] = data
    return out, ends[:, -1]


# --------------------------------------------------------------- decoding
class Lanes:
    """Blocks in one buffer, with a place in each."""

    def __init__(self, blocks: list[bytes]):
        self.raw = b"".join(blocks)
        self.buf = np.frombuffer(self.raw, np.uint8)
        self.end = np.cumsum([len(b) for b in blocks])
        self.at = self.end - [len(b) for b in blocks]

    def longs(self, ix: np.ndarray) -> np.ndarray:
        at = self.at[ix]
        b = self.buf[at]
        at += 1
        if b.max(initial=0) < 0x80:
            self.at[ix], out = at, b.astype(np.int64)
            return (out >> 1) ^ -(out & 1)
        out, more, shift = (b & 0x7F).astype(np.uint64), np.flatnonzero(b >= 0x80), 7
        while more.size:
            if shift > 63:
                raise ValueError("a number of an Avro file is too long")
            b = self.buf[at[more]]
            at[more] += 1
            out[more] |= (b & 0x7F).astype(np.uint64) << np.uint64(shift)
            more, shift = more[b >= 0x80], shift + 7
        self.at[ix] = at
        out = out.view(np.int64)
        return ((out >> 1) & 0x7FFFFFFFFFFFFFFF) ^ -(out & 1)

    def gather(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return self.buf[_spread(starts, lengths)]


class Node:
    """A field's values of one group of blocks. ``read`` takes lanes and the rows that they give."""

    def __init__(self, schema: dict, rows: int):
        self.schema, self.rows, self.ok = schema, rows, np.zeros(rows, bool)

    def none(self):
        return pa.array(~self.ok)


class Longs(Node):
    def __init__(self, schema, rows):
        super().__init__(schema, rows)
        self.out = np.zeros(rows, np.int64)

    def read(self, lanes, ix, rows):
        self.out[rows], self.ok[rows] = lanes.longs(ix), True

    def array(self, lanes, want):
        kind, logical, out = self.schema["type"], self.schema.get("logicalType") or "", self.out
        if kind == "enum":
            return pa.array(self.schema["symbols"], pa.string()).take(pa.array(out, mask=~self.ok))
        if kind == "int" and out.size and not -(1 << 31) <= out.min() <= out.max() < 1 << 31:
            raise ValueError("an int of an Avro file is too large")
        if logical == "date":
            return pa.array(out.astype(np.int32), mask=~self.ok).cast(pa.date32())
        if "timestamp" in logical:
            micros = pa.array(out * (1000 if logical.endswith("millis") else 1), mask=~self.ok)
            return micros.cast(pa.timestamp("us", None if logical.startswith("local") else "UTC"))
        return pa.array(out.astype(np.int32) if kind == "int" else out, mask=~self.ok)


class Fixed(Node):
    """Values of so many bytes: float, double, boolean."""

    KINDS = {"float": "<f4", "double": "<f8", "boolean": "u1"}

    def __init__(self, schema, rows):
        super().__init__(schema, rows)
        self.out = np.zeros(rows, self.KINDS[schema["type"]])

    def read(self, lanes, ix, rows):
        size, at = self.out.itemsize, lanes.at[ix]
        self.out[rows] = lanes.buf[at[:, None] + np.arange(size)].reshape(-1).view(self.out.dtype)
        lanes.at[ix], self.ok[rows] = at + size, True

    def array(self, lanes, want):
        return pa.array(self.out != 0 if self.schema["type"] == "boolean" else self.out, mask=~self.ok)


class Bytes(Node):
    """Values that stay where they are until the group is read: strings, bytes, fixed, decimals."""

    def __init__(self, schema, rows):
        super().__init__(schema, rows)
        self.start, self.size = np.zeros(rows, np.int64), np.zeros(rows, np.int64)

    def read(self, lanes, ix, rows):
        n = np.int64(self.schema["size"]) if self.schema["type"] == "fixed" else lanes.longs(ix)
        at = lanes.at[ix]
        if np.any(n < 0) or np.any(at + n > len(lanes.buf)):
            raise ValueError("a length of an Avro file is wrong")
        self.start[rows], self.size[rows], self.ok[rows] = at, n, True
        lanes.at[ix] = at + n

    def array(self, lanes, want):
        if self.schema.get("logicalType") == "decimal":
            return self.decimals(lanes, pa.decimal128(self.schema["precision"], self.schema.get("scale", 0)))
        data, ends = lanes.gather(self.start, self.size), np.concatenate([[0], np.cumsum(self.size)])
        valid = pa.array(self.ok).buffers()[1]
        kind = pa.large_string() if self.schema["type"] == "string" else pa.large_binary()
        out = pa.Array.from_buffers(kind, self.rows, [valid, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
        out.validate(full=kind == pa.large_string())
        return out

    def decimals(self, lanes, kind):
        if kind.precision > _WIDE or self.size.max(initial=0) > 8:
            whole = [int.from_bytes(lanes.raw[a:a + n], "big", signed=True) if ok else None
                     for a, n, ok in zip(self.start.tolist(), self.size.tolist(), self.ok.tolist())]
            import decimal

            with decimal.localcontext(prec=80):
                return pa.array([None if v is None else decimal.Decimal(v).scaleb(-kind.scale) for v in whole], kind)
        out = np.zeros(self.rows, np.int64)
        for k in range(int(self.size.max(initial=0))):
            some = np.flatnonzero(self.size > k)
            b = lanes.buf[self.start[some] + k]
            out[some] = out[some] << 8 | b if k else b.view(np.int8)
        if np.any(np.abs(out) >= _TENS[kind.precision]):
            raise ValueError("a decimal of an Avro file has too many digits")
        pairs = np.stack([out, out >> 63], axis=1)
        return pa.Array.from_buffers(kind, self.rows, [pa.array(self.ok).buffers()[1], pa.py_buffer(pairs)])


class Values(Node):
    """Arrays, maps and nulls: each value by the reader of one value."""

    def __init__(self, schema, rows, by_value):
        super().__init__(schema, rows)
        self.out, self.one = [None] * rows, by_value(schema)

    def read(self, lanes, ix, rows):
        from skyledger.sources.avro import Cursor

        for i, row in zip(ix.tolist(), rows.tolist()):
            c = Cursor(lanes.raw, int(lanes.at[i]))
            self.out[row], lanes.at[i] = self.one(c), c.at

    def array(self, lanes, want):
        return pa.array(self.out, want)


class Record(Node):
    def __init__(self, schema, rows, by_value):
        super().__init__(schema, rows)
        self.fields = {f["name"]: node_of(f["type"], rows, by_value) for f in schema["fields"]}

    def read(self, lanes, ix, rows):
        self.ok[rows] = True
        for node in self.fields.values():
            node.read(lanes, ix, rows)

    def columns(self, lanes, want) -> list[pa.Array]:
        """The wanted fields by name; null where the file has none."""
        out = []
        for f in want:
            arr = self.fields[f.name].array(lanes, f.type) if f.name in self.fields else pa.nulls(self.rows, f.type)
            out.append(arr if arr.type == f.type else arr.cast(f.type))
        return out

    def array(self, lanes, want):
        want = list(want)
        return pa.StructArray.from_arrays(self.columns(lanes, want), fields=want, mask=self.none())


class Union(Node):
    def __init__(self, schema, rows, by_value):
        super().__init__(schema, rows)
        self.branches = [node_of(s, rows, by_value) if s != "null" else None for s in schema]

    def read(self, lanes, ix, rows):
        which = lanes.longs(ix)
        if which.size and not 0 <= which.min() <= which.max() < len(self.branches):
            raise ValueError("a union of an Avro file has no such type")
        for k, node in enumerate(self.branches):
            if node is not None:
                some = which == k
                if some.all():
                    node.read(lanes, ix, rows)
                elif some.any():
                    node.read(lanes, ix[some], rows[some])

    def array(self, lanes, want):
        return next(n for n in self.branches if n is not None).array(lanes, want)


def node_of(schema, rows: int, by_value) -> Node:
    if isinstance(schema, list):
        return Union(schema, rows, by_value)
    if isinstance(schema, str):
        schema = {"type": schema}
    kind = schema["type"]
    if isinstance(kind, dict | list):
        return node_of(kind, rows, by_value)
    if kind == "record":
        return Record(schema, rows, by_value)
    if kind in ("array", "map", "null"):
        return Values(schema, rows, by_value)
    if kind in Fixed.KINDS:
        return Fixed(schema, rows)
    return (Longs if kind in ("int", "long", "enum") else Bytes)(schema, rows)


def _one_by_one(blocks: list[tuple[int, bytes]], schema: dict, want: pa.Schema, by_value) -> pa.RecordBatch:
    from skyledger.sources.avro import Cursor

    one, rows = by_value(schema), []
    for n, data in blocks:
        c = Cursor(data)
        rows += [one(c) for _ in range(n)]
    return pa.RecordBatch.from_pylist(rows, want)


def decode(blocks: list[tuple[int, bytes]], schema: dict, want: pa.Schema, by_value) -> pa.RecordBatch:
    """The records of a group of blocks (count, bytes), in their order, with the wanted fields."""
    blocks = [b for b in blocks if b[0] > 0]
    if len(blocks) < FEW_BLOCKS and sum(n for n, _ in blocks) >= MANY_ROWS:
        return _one_by_one(blocks, schema, want, by_value)
    counts = np.array([n for n, _ in blocks], np.int64)
    first, rows, lanes = np.cumsum(counts) - counts, int(counts.sum()), Lanes([data for _, data in blocks])
    record = Record(schema, rows, by_value)
    order = np.argsort(-counts, kind="stable")  # the blocks that have a record r come first
    having = np.searchsorted(-counts[order], -np.arange(int(counts.max(initial=0))), side="left")
    try:
        for r, n in enumerate(having):
            ix = order[:n]
            record.read(lanes, ix, first[ix] + r)
    except IndexError:
        raise ValueError("a block of an Avro file is damaged") from None
    if np.any(lanes.at != lanes.end):
        raise ValueError("a block of an Avro file is damaged")
    if not len(want):
        return pa.RecordBatch.from_struct_array(pa.array([{}] * rows, pa.struct([])))
    return pa.RecordBatch.from_arrays(record.columns(lanes, list(want)), schema=want)
