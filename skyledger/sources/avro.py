"""Avro container files through Spark's Python Data Source API.

The schema comes from a file's header. A file is read in splits of ``split_bytes``: a block
belongs to the split in which the sync marker before it begins, so a task looks for the first
marker of its split, and reads whole blocks from there. Tasks take and return Arrow batches, and
rows are coded a column at a time (``avro_columns``). Writing gives one file per task; files get
their names when all tasks are done, and those of failed attempts are deleted.

Files are opened through pyarrow's file systems (local, HDFS, S3, ...). Codecs: null, deflate,
zstandard. Types: records, arrays, maps, unions with null, enums, fixed, and the logical types
date, timestamp and decimal; a union of several types is an error, as Spark has none.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import os
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from skyledger.session import ship_package
from skyledger.sources import avro_columns

FORMAT = "avro_container"
MAGIC = b"Obj\x01"
SPLIT_BYTES = 64 << 20
BATCH_ROWS = 8192
GROUP_BYTES = 16 << 20  # blocks that are decoded side by side
BLOCK_BYTES = 16 << 10
WINDOW_BYTES = 4 << 20
_EPOCH = dt.datetime(1970, 1, 1)
_UTC = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def _file_system(path: str):
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def data_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the files of a folder that are not hidden."""
    from pyarrow import fs

    system, root = _file_system(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return [(info.path, info.size)]
    if info.type != fs.FileType.Directory:
        raise FileNotFoundError(path)
    found = system.get_file_info(fs.FileSelector(root))
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._")


# ----------------------------------------------------------------- schema
def spark_type(schema) -> tuple[T.DataType, bool]:
    """(Spark type, nullable) of an Avro schema."""
    if isinstance(schema, list):
        some = [s for s in schema if s != "null"]
        if len(some) != 1:
            raise ValueError(f"a union of several types: {schema}")
        return spark_type(some[0])[0], "null" in schema
    if isinstance(schema, str):
        schema = {"type": schema}
    kind, logical = schema["type"], schema.get("logicalType")
    if isinstance(kind, dict | list):
        return spark_type(kind)
    if kind == "record":
        fields = []
        for f in schema["fields"]:
            of, nullable = spark_type(f["type"])
            fields.append(T.StructField(f["name"], of, nullable))
        return T.StructType(fields), False
    if kind == "array":
        return T.ArrayType(*spark_type(schema["items"])), False
    if kind == "map":
        return T.MapType(T.StringType(), *spark_type(schema["values"])), False
    if logical == "decimal":
        return T.DecimalType(schema["precision"], schema.get("scale", 0)), False
    if logical == "date":
        return T.DateType(), False
    if logical in ("timestamp-millis", "timestamp-micros"):
        return T.TimestampType(), False
    if logical in ("local-timestamp-millis", "local-timestamp-micros"):
        return T.TimestampNTZType(), False
    plain = {"string": T.StringType, "enum": T.StringType, "bytes": T.BinaryType, "fixed": T.BinaryType, "int": T.IntegerType,
             "long": T.LongType, "float": T.FloatType, "double": T.DoubleType, "boolean": T.BooleanType, "null": T.NullType}
    if kind not in plain:
        raise ValueError(f"unknown type {kind!r}; named types must be spelled out where they are used")
    return plain[kind](), kind == "null"


def avro_schema(of: T.DataType, nullable: bool = False, name: str = "row"):
    """An Avro schema of a Spark type."""
    if isinstance(of, T.StructType):
        out = {"type": "record", "name": name,
               "fields": [{"name": f.name, "type": avro_schema(f.dataType, f.nullable, f"{name}_{f.name}")} for f in of.fields]}
    elif isinstance(of, T.ArrayType):
        out = {"type": "array", "items": avro_schema(of.elementType, of.containsNull, f"{name}_item")}
    elif isinstance(of, T.MapType):
        out = {"type": "map", "values": avro_schema(of.valueType, of.valueContainsNull, f"{name}_value")}
    elif isinstance(of, T.DecimalType):
        out = {"type": "bytes", "logicalType": "decimal", "precision": of.precision, "scale": of.scale}
    else:
        plain = {T.StringType: "string", T.BinaryType: "bytes", T.IntegerType: "int", T.ShortType: "int", T.ByteType: "int",
                 T.LongType: "long", T.FloatType: "float", T.DoubleType: "double", T.BooleanType: "boolean",
                 T.DateType: {"type": "int", "logicalType": "date"},
                 T.TimestampType: {"type": "long", "logicalType": "timestamp-micros"},
                 T.TimestampNTZType: {"type": "long", "logicalType": "local-timestamp-micros"}}
        if type(of) not in plain:
            raise ValueError(f"no Avro type for {of.simpleString()}")
        out = plain[type(of)]
    return ["null", out] if nullable else out


# ---------------------------------------------------------------- reading
class Cursor:
    """Bytes and a place in them."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def long(self) -> int:
        value = shift = 0
        while True:
            b = self.data[self.at]
            self.at += 1
            value |= (b & 0x7F) << shift
            if b < 0x80:
                return (value >> 1) ^ -(value & 1)
            shift += 7

    def take(self, n: int) -> bytes:
        self.at += n
        return self.data[self.at - n:self.at]


def reader_of(schema):
    """A function from a Cursor to a value."""
    import struct

    if isinstance(schema, list):
        branches = [reader_of(s) for s in schema]
        return lambda c: branches[c.long()](c)
    if isinstance(schema, str):
        schema = {"type": schema}
    kind, logical = schema["type"], schema.get("logicalType")
    if isinstance(kind, dict | list):
        return reader_of(kind)
    if kind == "record":
        fields = [(f["name"], reader_of(f["type"])) for f in schema["fields"]]
        return lambda c: {name: read(c) for name, read in fields}
    if kind in ("array", "map"):
        item = reader_of(schema["items" if kind == "array" else "values"])
        one = item if kind == "array" else lambda c: (c.take(c.long()).decode(), item(c))

        def many(c):
            out = []
            while n := c.long():
                if n < 0:
                    n, _ = -n, c.long()
                out += [one(c) for _ in range(n)]
            return out

        return many
    if kind in ("bytes", "fixed"):
        size = schema.get("size")
        take = (lambda c: c.take(size)) if kind == "fixed" else (lambda c: c.take(c.long()))
        if logical != "decimal":
            return take
        scale = -schema.get("scale", 0)
        return lambda c: decimal.Decimal(int.from_bytes(take(c), "big", signed=True)).scaleb(scale)
    if kind == "enum":
        return lambda c: schema["symbols"][c.long()]
    if logical == "date":
        return lambda c: dt.date.fromordinal(719163 + c.long())
    if logical and "timestamp" in logical:
        unit, start = (1000 if logical.endswith("millis") else 1), (_EPOCH if logical.startswith("local") else _UTC)
        return lambda c: start + dt.timedelta(microseconds=unit * c.long())
    float_, double = struct.Struct("<f"), struct.Struct("<d")
    return {"null": lambda c: None, "boolean": lambda c: c.take(1) != b"\0", "int": Cursor.long, "long": Cursor.long,
            "float": lambda c: float_.unpack(c.take(4))[0], "double": lambda c: double.unpack(c.take(8))[0],
            "string": lambda c: c.take(c.long()).decode()}[kind]


def _unpacked(codec: str, data: bytes) -> bytes:
    if codec == "null":
        return data
    if codec == "deflate":
        return zlib.decompress(data, -15)
    if codec == "zstandard":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    raise ValueError(f"unknown codec {codec!r}")


@dataclass
class Header:
    schema: dict
    codec: str
    sync: bytes
    end: int


def read_header(file) -> Header:
    size = 4096
    while True:
        data = file.read_at(min(size, file.size()), 0)
        if data[:4] != MAGIC:
            raise ValueError("not an Avro container file")
        try:
            c, meta = Cursor(data, 4), {}
            while n := c.long():
                if n < 0:
                    n, _ = -n, c.long()
                for _ in range(n):
                    key = c.take(c.long()).decode()
                    meta[key] = c.take(c.long())
            if c.at + 16 <= len(data):
                return Header(json.loads(meta["avro.schema"]), meta.get("avro.codec", b"null").decode(), c.take(16), c.at)
        except IndexError:
            pass
        if size >= file.size():
            raise ValueError("the header of an Avro file is cut off")
        size *= 4


class Window:
    """A file read in pieces of some MB, whatever the lengths asked for."""

    def __init__(self, file):
        self.file, self.size, self.at, self.data = file, file.size(), 0, b""

    def read(self, n: int, at: int) -> bytes:
        if not self.at <= at <= at + n <= self.at + len(self.data):
            self.data, self.at = self.file.read_at(min(max(n, WINDOW_BYTES), self.size - at), at), at
        return self.data[at - self.at:at - self.at + n]


def blocks(file, header: Header, begin: int, end: int):
    """(count, records) of the blocks whose preceding sync marker begins in [begin, end)."""
    size, at, step = file.size(), begin, 1 << 20
    while True:  # the first marker of the split
        data = file.read_at(min(step + 15, size - at), at) if at < end else b""
        found = data.find(header.sync)
        if found >= 0 and at + found < end:
            at += found + 16
            break
        if at + step >= end or at + len(data) >= size:
            return
        at += step
    window = Window(file)
    while at < size and at - 16 < end:
        c = Cursor(window.read(min(20, size - at), at))
        count, n = c.long(), c.long()
        data = window.read(n + 16, at + c.at)
        if len(data) < n + 16 or data[n:] != header.sync:
            raise ValueError("a block of an Avro file is damaged")
        yield count, _unpacked(header.codec, data[:n])
        at += c.at + n + 16


@dataclass
class Split(InputPartition):
    path: str
    begin: int
    end: int

    def __init__(self, path: str, begin: int, end: int):
        self.path, self.begin, self.end = path, begin, end


class ContainerReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.schema = options["path"], schema
        self.split = int(options.get("split_bytes", SPLIT_BYTES))

    def partitions(self):
        return [Split(p, a, min(a + self.split, size)) for p, size in data_files(self.path)
                for a in range(0, size, self.split)]

    def read(self, split: Split):
        from pyspark.sql.pandas.types import to_arrow_schema

        system, _ = _file_system(self.path)
        arrow = to_arrow_schema(self.schema)
        with system.open_input_file(split.path) as file:
            header = read_header(file)

            def batches(group):
                rows = avro_columns.decode(group, header.schema, arrow, reader_of)
                for a in range(0, rows.num_rows, BATCH_ROWS):
                    yield rows.slice(a, BATCH_ROWS)

            group, size = [], 0
            for count, data in blocks(file, header, split.begin, split.end):
                group.append((count, data))
                size += len(data)
                if size >= GROUP_BYTES:
                    yield from batches(group)
                    group, size = [], 0
            if group:
                yield from batches(group)


# ---------------------------------------------------------------- writing
def _long(value: int) -> bytes:
    value, out = (value << 1) ^ (value >> 63), bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def writer_of(of: T.DataType, nullable: bool):
    """A function from a value, as Arrow gives it, to its bytes."""
    import struct

    if nullable:
        one = writer_of(of, False)
        return lambda v: b"\0" if v is None else b"\2" + one(v)
    if isinstance(of, T.StructType):
        fields = [(f.name, writer_of(f.dataType, f.nullable)) for f in of.fields]
        return lambda v: b"".join([write(v[name]) for name, write in fields])
    if isinstance(of, T.ArrayType | T.MapType):
        items = isinstance(of, T.ArrayType)
        item = writer_of(of.elementType, of.containsNull) if items else writer_of(of.valueType, of.valueContainsNull)
        text = writer_of(T.StringType(), False)
        one = item if items else lambda kv: text(kv[0]) + item(kv[1])
        return lambda v: (_long(len(v)) + b"".join(map(one, v)) if v else b"") + b"\0"
    if isinstance(of, T.DecimalType):
        def number(v):
            n = int(v.scaleb(of.scale))
            data = n.to_bytes(n.bit_length() // 8 + 1, "big", signed=True)
            return _long(len(data)) + data

        return number
    if isinstance(of, T.StringType | T.BinaryType):
        def text_of(v):
            data = v.encode() if isinstance(v, str) else bytes(v)
            return _long(len(data)) + data

        return text_of
    if isinstance(of, T.DateType):
        return lambda v: _long(v.toordinal() - 719163)
    if isinstance(of, T.TimestampNTZType | T.TimestampType):
        def instant(v):
            since = v - _EPOCH if v.tzinfo is None and isinstance(of, T.TimestampNTZType) else v.astimezone(dt.timezone.utc) - _UTC
            return _long(since // dt.timedelta(microseconds=1))

        return instant
    if isinstance(of, T.FloatType | T.DoubleType):
        return struct.Struct("<f" if isinstance(of, T.FloatType) else "<d").pack
    if isinstance(of, T.BooleanType):
        return lambda v: b"\1" if v else b"\0"
    return _long


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class ContainerWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: T.StructType, overwrite: bool):
        if overwrite:
            raise ValueError("container files are never overwritten; write to a new folder")
        self.root, self.schema = options["path"], schema
        self.block = int(options.get("block_bytes", BLOCK_BYTES))

    def write(self, batches):
        system, root = _file_system(self.root)
        sync = uuid.uuid4().bytes
        path, held, n, size = f"{root}/.{uuid.uuid4().hex}.part", [], 0, 0
        system.create_dir(root, recursive=True)
        meta = {"avro.schema": json.dumps(avro_schema(self.schema)).encode(), "avro.codec": b"deflate"}
        with system.open_output_stream(path) as out:
            def text(data):
                return _long(len(data)) + data

            out.write(MAGIC + _long(len(meta)) + b"".join(text(k.encode()) + text(v) for k, v in meta.items()) + b"\0" + sync)

            def flush():
                pack = zlib.compressobj(zlib.Z_BEST_SPEED, wbits=-15)
                data = pack.compress(b"".join(held)) + pack.flush()
                out.write(_long(n) + _long(len(data)) + data + sync)

            for batch in batches:
                data, ends = avro_columns.encode(batch, self.schema, lambda of: writer_of(of, False))
                row = start = 0
                while row < len(ends):  # a block is full with the row that fills it
                    cut = min(int(np.searchsorted(ends, start + self.block - size)) + 1, len(ends))
                    end = int(ends[cut - 1])
                    held.append(data[start:end].tobytes())
                    n, size = n + cut - row, size + end - start
                    if size >= self.block:
                        flush()
                        held, n, size = [], 0, 0
                    row, start = cut, end
            if n:
                flush()
        return Written(path)

    def commit(self, messages):
        system, _ = _file_system(self.root)
        for k, m in enumerate(m for m in messages if m):
            folder = os.path.dirname(m.path)
            system.move(m.path, f"{folder}/part-{k:05d}.avro")

    def abort(self, messages):
        system, _ = _file_system(self.root)
        for m in messages:
            if m:
                system.delete_file(m.path)


class ContainerSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        files = data_files(self.options["path"])
        if not files:
            raise ValueError("no Avro files, so no schema")
        system, _ = _file_system(self.options["path"])
        with system.open_input_file(files[0][0]) as file:
            return spark_type(read_header(file).schema)[0]

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ContainerReader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return ContainerWriter(dict(self.options), schema, overwrite)


def register_avro(spark: SparkSession) -> str:
    """Make the format known to a session; returns its name."""
    ship_package(spark)
    spark.dataSource.register(ContainerSource)
    return FORMAT
