"""Avro container files: round trips, splits at sync markers, codecs, and a load equal to its Parquet twin."""

import datetime as dt
import json
import zlib
from decimal import Decimal

import pytest
import zstandard
from pyspark.sql import types as T

from skyledger.operators import billing as B
from skyledger.sources import avro as A
from skyledger.sources import catalog as C
from skyledger.sources import fixtures as fx

from conftest import SF_SMALL


def test_round_trip_of_all_types(spark, tmpdir_path):
    schema = ("i int, l long, f float, d double, b boolean, s string, y binary, day date, t timestamp, n timestamp_ntz, m decimal(12,3), "
              "a array<int>, p map<string,long>, r struct<x:string,q:array<struct<z:double>>>")
    at = dt.datetime(1969, 12, 31, 23, 59, 59, 999999)
    rows = [(1, -(1 << 62), 0.5, -2.25, True, "é\u2028", b"\0\xff", dt.date(1960, 2, 29), dt.datetime(2024, 1, 1), at, Decimal("-12.345"),
             [1, None, -3], {"k": 7, "": None}, ("x", [(1.5,), None])),
            tuple([None] * 14), (0, 0, 0.0, 0.0, False, "", b"", dt.date(1970, 1, 1), dt.datetime(1970, 1, 1), at, Decimal("0.000"), [], {}, (None, []))]
    df = spark.createDataFrame(rows, schema)
    df.write.format(A.register_avro(spark)).mode("append").save(f"{tmpdir_path}/t")
    back = C.read_source(spark, f"{tmpdir_path}/t", "avro")
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def container(path, schema, records, codec="null", per_block=3, sync=b"0123456789abcdef"):
    """A file by hand: ``records`` are encoded already."""
    def text(b):
        return A._long(len(b)) + b

    out = A.MAGIC + A._long(2) + text(b"avro.schema") + text(json.dumps(schema).encode()) + text(b"avro.codec") + text(codec.encode()) + b"\0" + sync
    for i in range(0, len(records), per_block):
        data = b"".join(records[i:i + per_block])
        pack = zlib.compressobj(wbits=-15)
        data = {"null": lambda: data, "deflate": lambda: pack.compress(data) + pack.flush(), "zstandard": lambda: zstandard.compress(data)}.get(
            codec, lambda: data)()
        out += A._long(len(records[i:i + per_block])) + text(data) + sync
    with open(path, "wb") as f:
        f.write(out)


@pytest.mark.parametrize("codec", ["null", "deflate", "zstandard"])
@pytest.mark.parametrize("split", [7, 64, 1000, 1 << 20])
def test_every_split_size_reads_every_record_once(tmpdir_path, codec, split):
    schema = {"type": "record", "name": "r", "fields": [{"name": "i", "type": "long"}, {"name": "s", "type": ["string", "null"]}]}
    records = [A._long(i) + (b"\2" if i % 5 == 0 else b"\0" + A._long(i % 90) + b"x" * (i % 90)) for i in range(200)]
    container(f"{tmpdir_path}/f.avro", schema, records, codec)
    reader = A.ContainerReader({"path": tmpdir_path, "split_bytes": str(split)}, A.spark_type(schema)[0])
    parts = [[r for b in reader.read(p) for r in b.to_pylist()] for p in reader.partitions()]
    assert [r["i"] for p in parts for r in p] == list(range(200))
    assert [r["s"] for p in parts for r in p] == [None if i % 5 == 0 else "x" * (i % 90) for i in range(200)]


def test_damaged_files_are_errors(tmpdir_path):
    schema = {"type": "record", "name": "r", "fields": [{"name": "i", "type": "long"}]}
    path = f"{tmpdir_path}/f.avro"

    def read():
        reader = A.ContainerReader({"path": path}, A.spark_type(schema)[0])
        return [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]

    container(path, schema, [A._long(i) for i in range(9)])
    assert len(read()) == 9
    whole = open(path, "rb").read()
    for broken in (whole[:-5], b"Obx" + whole[3:], whole[:40], whole[:-16] + b"fedcba9876543210"):
        with open(path, "wb") as f:
            f.write(broken)
        with pytest.raises(ValueError):
            read()
    container(path, schema, [A._long(1)], codec="snappy")
    with pytest.raises(ValueError):
        read()
    with pytest.raises(ValueError):
        A.spark_type(["null", "int", "string"])
    with pytest.raises(FileNotFoundError):
        A.data_files(f"{tmpdir_path}/none")


def test_other_types_of_the_format(tmpdir_path):
    schema = {"type": "record", "name": "r", "fields": [
        {"name": "e", "type": {"type": "enum", "name": "e", "symbols": ["A", "B"]}}, {"name": "x", "type": {"type": "fixed", "name": "x", "size": 2}},
        {"name": "t", "type": {"type": "long", "logicalType": "timestamp-millis"}}, {"name": "a", "type": {"type": "array", "items": "int"}}]}
    blocks = A._long(-2) + A._long(2) + A._long(5) + A._long(6) + A._long(1) + A._long(7) + b"\0"  # one with its size, one without
    container(f"{tmpdir_path}/f.avro", schema, [A._long(1) + b"hi" + A._long(1500) + blocks])
    struct = A.spark_type(schema)[0]
    assert [f.dataType for f in struct.fields] == [T.StringType(), T.BinaryType(), T.TimestampType(), T.ArrayType(T.IntegerType(), False)]
    reader = A.ContainerReader({"path": tmpdir_path}, struct)
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [(r["e"], r["x"], r["a"]) for r in rows] == [("B", b"hi", [5, 6, 7])] and rows[0]["t"].timestamp() == 1.5


def test_a_billing_export_in_blocks_equals_its_parquet_twin(spark, tmpdir_path):
    export = fx.billing(spark, SF_SMALL)
    export.write.parquet(f"{tmpdir_path}/twin")
    spark.read.parquet(f"{tmpdir_path}/twin").coalesce(1).write.format(A.register_avro(spark)).mode("append").option(
        "block_bytes", "20000").save(f"{tmpdir_path}/avro")
    assert len(A.data_files(f"{tmpdir_path}/avro")) == 1
    back = C.read_source(spark, f"{tmpdir_path}/avro", "avro", split_bytes="40000")
    from pyspark.sql import functions as F
    sizes = [r["count"] for r in back.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 3  # several tasks had rows
    name = C.load_table(spark, back, "t_ds", "t_avro", mode="overwrite")
    want = B.flatten(spark.read.parquet(f"{tmpdir_path}/twin"))
    assert sorted(B.flatten(spark.table(name)).collect(), key=str) == sorted(want.collect(), key=str)


def test_rows_are_coded_by_column_not_by_value(spark, tmpdir_path, monkeypatch):
    df = spark.range(6000).selectExpr(
        "id AS l", "if(id % 7 = 0, null, concat('é', id)) AS s", "if(id % 5 = 0, null, named_struct('x', cast(id AS int) - 3000, 'm', "
        "if(id % 3 = 0, null, cast(id * 7919 - 20000000 AS decimal(12,2))))) AS r", "cast(id AS double) / 3 AS d", "id % 2 = 0 AS b",
        "date_add(date'1969-12-01', cast(id % 90 AS int)) AS day", "cast(concat('b', id * id) AS binary) AS y",
        "cast(id - 3000 AS decimal(30,4)) AS wide", "cast(1e-3 * id AS float) AS f", "timestamp_micros(id * 1000003 - 9) AS t")
    df.repartition(2).write.format(A.register_avro(spark)).mode("append").save(f"{tmpdir_path}/t")
    back = C.read_source(spark, f"{tmpdir_path}/t", "avro", split_bytes="30000")
    assert back.count() == 6000
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0

    calls, plain = [], A.Cursor.long
    monkeypatch.setattr(A.Cursor, "long", lambda c: calls.append(1) or plain(c))
    narrow = T.StructType([f for f in back.schema.fields if f.name != "day"])
    reader = A.ContainerReader({"path": f"{tmpdir_path}/t"}, narrow)
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(r["l"] for r in rows) == list(range(6000)) and "day" not in rows[0]
    assert len(calls) < len(rows) / 4  # headers and blocks, no values


def test_columns_are_the_bytes_of_the_values(spark):
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    from skyledger.sources import avro_columns as AC

    schema = T.StructType([T.StructField("i", T.LongType(), False), T.StructField("m", T.DecimalType(18, 2)),
                           T.StructField("r", T.StructType([T.StructField("s", T.StringType(), False), T.StructField("z", T.ArrayType(T.IntegerType()))]))])
    ends = [0, 1, -1, 63, 64, -64, -65, 8191, 8192, (1 << 62) - 1, -(1 << 62), (1 << 63) - 1, -(1 << 63)]
    cents = [0, 127, 128, -127, -128, -129, 32767, 32768, -32768, 10**18 - 1, 1 - 10**18, None, 5]
    rows = [{"i": i, "m": None if c is None else Decimal(c).scaleb(-2), "r": None if k % 4 == 3 else {"s": "ü" * k, "z": [k, None] if k % 2 else None}}
            for k, (i, c) in enumerate(zip(ends, cents))]
    arrow = to_arrow_schema(schema)
    batch, one = pa.RecordBatch.from_pylist(rows, arrow), A.writer_of(schema, False)
    data, at = AC.encode(batch.slice(2), schema, lambda of: A.writer_of(of, False))
    assert data.tobytes() == b"".join(map(one, rows[2:])) and at[-1] == len(data)
    blocks = [(3, b"".join(map(one, rows[:3]))), (0, b""), (10, b"".join(map(one, rows[3:])))]
    assert AC.decode(blocks, A.avro_schema(schema), arrow, A.reader_of).to_pylist() == rows
    long = [(500, b"".join(map(one, rows[:1])) * 500)] * 9  # few long blocks, by value
    assert AC.decode(long, A.avro_schema(schema), arrow, A.reader_of).to_pylist() == rows[:1] * 4500
    assert AC.decode(long[:2] * 2 + long[:5], A.avro_schema(schema), arrow, A.reader_of).num_rows == 4500
    with pytest.raises(ValueError):
        AC.decode([(3, blocks[0][1][:-1])], A.avro_schema(schema), arrow, A.reader_of)
