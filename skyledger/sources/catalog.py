"""Datasets, table loads, metadata, statistics and file formats.

Tables are written below the shared storage root (``spark.checkpoint.dir``)
with an explicit path, so a catalog entry can always be recreated over it.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.session import storage_root
from skyledger.sources import literals
from skyledger.sources import versions as V
from skyledger.sources.avro import register_avro

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def create_dataset(spark: SparkSession, name: str, description: str = "",
                   default_ttl_s: int = literals.DATASET_DEFAULT_TTL_S, location: str = "US",
                   if_not_exists: bool = True) -> DataFrame:
    """A namespace with a description and a default table TTL (database properties). One that exists
    without a description, as a load makes it, takes the one given."""
    desc = description.replace("'", "''")
    spark.sql(f"CREATE DATABASE {'IF NOT EXISTS ' if if_not_exists else ''}{_ident(name)} "
              f"COMMENT '{desc}' WITH DBPROPERTIES ('default_table_ttl_s'='{int(default_ttl_s)}', "
              f"'data_location'='{location}')")
    if description and describe_dataset(spark, name).where("info_name = 'Comment' AND info_value = ''").count():
        spark.sql(f"COMMENT ON DATABASE {name} IS '{desc}'")
    return describe_dataset(spark, name)


def describe_dataset(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE DATABASE EXTENDED {_ident(name)}")


def read_source(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str | None = None,
                **options: str) -> DataFrame:
    """Read a self-describing file (parquet, orc, json, csv, avro container files)."""
    r = spark.read.format(register_avro(spark) if fmt == "avro" else fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


SOURCE_PROPERTY = "skyledger.source"


def load_table(spark: SparkSession, source: DataFrame | str, dataset: str, table: str,
               fmt: str = "parquet", mode: str = "append", source_tag: str | None = None,
               keep_s: float = literals.DATASET_DEFAULT_TTL_S) -> str:
    """Load a DataFrame (or a file in ``fmt``) into dataset.table; schema from the source.

    ``mode="append"`` (the default) adds rows to an existing table and creates
    it otherwise; ``"overwrite"`` replaces it by a new version (see ``versions``): results of
    the one before can still be read for ``keep_s`` seconds after it was replaced.
    ``source_tag`` is stored as a table property so later steps can tell which input the
    table holds (see ``loaded_from``).
    """
    df = read_source(spark, source, fmt) if isinstance(source, str) else source
    create_dataset(spark, dataset)
    name = f"{_ident(dataset)}.{_ident(table)}"
    tag = source_tag if source_tag is not None else (source if isinstance(source, str) else None)
    if mode == "append" and spark.catalog.tableExists(name):
        df.write.mode("append").saveAsTable(name)
    else:
        version, path = V.new_version(spark, dataset, table)
        df.write.mode(mode).format("parquet").option("path", path).saveAsTable(name)
        V.publish(spark, dataset, table, version, path, tag)
        V.remove_old(spark, dataset, table, keep_s)
    if tag is not None:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{SOURCE_PROPERTY}' = '{_quote(tag)}')")
    return name


def location(spark: SparkSession, name: str) -> str | None:
    """Where a table's files are, or None when the table is absent."""
    if not spark.catalog.tableExists(name):
        return None
    row = describe_table(spark, name).where("col_name = 'Location'").first()
    return row.data_type if row else None


def source_stamp(spark: SparkSession, paths: list[str]) -> str:
    """What the files below ``paths`` are now: a digest of their names, lengths and modification
    times, computed by one job over the listing (contents are not read). It changes when a file is
    added, removed or rewritten."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    return ":".join(map(str, files.agg(F.count("*"), F.sum("length"), F.sum(one)).first()))


def expired_tables(spark: SparkSession, dataset: str, now: str) -> DataFrame:
    """Tables of a dataset with their creation time, when its default TTL ends, and whether that has
    passed at ``now``. A catalogue listing: one row per table."""
    ttl = next((int(m[1]) for r in describe_dataset(spark, dataset).collect()
                for m in [re.search(r"default_table_ttl_s,\s*([0-9]+)", str(r[1]))] if m), None)
    rows = []
    for t in spark.catalog.listTables(_ident(dataset)):
        detail = describe_table(spark, f"{dataset}.{t.name}").where("col_name = 'Created Time'").first()
        rows.append((t.name, detail.data_type if detail else None))
    created = F.try_to_timestamp(F.regexp_replace("created", r"^[A-Za-z]+ | [A-Z]+(?= [0-9]{4}$)", ""),
                                 F.lit("MMM dd HH:mm:ss yyyy")).cast("timestamp_ntz")
    expires = F.col("created_at") + F.make_interval(secs=F.lit(ttl)) if ttl else F.lit(None).cast("timestamp_ntz")
    return (spark.createDataFrame(rows, "name string, created string").select("name", created.alias("created_at"))
            .withColumn("expires_at", expires.cast("timestamp_ntz"))
            .withColumn("expired", F.coalesce(F.col("expires_at") <= F.lit(now).cast("timestamp_ntz"), F.lit(False))))


def _quote(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def loaded_from(spark: SparkSession, name: str) -> str | None:
    """The source tag of an existing table, or None when the table is absent."""
    if not spark.catalog.tableExists(name):
        return None
    props = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return props.get(SOURCE_PROPERTY)


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def schema_fields(schema: T.StructType) -> list[tuple[str, str, bool]]:
    """Flatten a nested schema into (path, type, nullable) — arrays add '[]'."""
    out: list[tuple[str, str, bool]] = []

    def walk(dt: T.DataType, path: str, nullable: bool) -> None:
        if isinstance(dt, T.StructType):
            if path:
                out.append((path, "struct", nullable))
            for f in dt.fields:
                walk(f.dataType, f"{path}.{f.name}" if path else f.name, f.nullable)
        elif isinstance(dt, T.ArrayType):
            out.append((path, "array", nullable))
            walk(dt.elementType, path + "[]", dt.containsNull)
        else:
            out.append((path, dt.simpleString(), nullable))

    walk(schema, "", True)
    return out


def schema_json(df: DataFrame) -> str:
    """The nested schema as pretty-printed JSON (``show --schema --format=prettyjson``)."""
    return json.dumps(df.schema.jsonValue(), indent=2)


def schema_frame(spark: SparkSession, df: DataFrame) -> DataFrame:
    return spark.createDataFrame(schema_fields(df.schema), "path string, type string, nullable boolean")


def table_stats(spark: SparkSession, name: str) -> DataFrame:
    """num_rows and num_bytes of a table in one pass, and its stored bytes from the catalog
    (ANALYZE TABLE ... NOSCAN). num_bytes is the logical size of the rows (see ``logical_bytes``),
    which does not depend on how the table is stored."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    text = describe_table(spark, name).where("col_name = 'Statistics'").first().data_type
    stored = int(re.search(r"([0-9]+) bytes", text)[1])
    return table_bytes(spark.table(name)).select(
        "num_rows", "num_bytes", F.lit(stored).cast("bigint").alias("stored_bytes"))


def logical_bytes(dt: T.DataType, value: Column) -> Column:
    """Logical size of a value: numbers, dates and times 8 bytes (decimals 16, booleans 1), text 2 bytes
    and its UTF-8 bytes, structs and arrays the sum of their parts, null 0."""
    if isinstance(dt, T.StructType):
        parts = [logical_bytes(f.dataType, value[f.name]) for f in dt.fields]
        size = sum(parts[1:], parts[0]) if parts else F.lit(0).cast("bigint")
    elif isinstance(dt, T.ArrayType):
        size = F.aggregate(value, F.lit(0).cast("bigint"), lambda a, x: a + logical_bytes(dt.elementType, x))
    elif isinstance(dt, T.StringType | T.BinaryType):
        size = (F.octet_length(value) + 2).cast("bigint")
    else:
        size = F.lit(16 if isinstance(dt, T.DecimalType) else 1 if isinstance(dt, T.BooleanType) else 8).cast("bigint")
    return F.when(value.isNull(), F.lit(0).cast("bigint")).otherwise(size)


def table_bytes(df: DataFrame) -> DataFrame:
    """num_rows and num_bytes of a frame: the sum of its rows' logical sizes."""
    size = [logical_bytes(f.dataType, F.col(f"`{f.name}`")) for f in df.schema.fields]
    return df.agg(F.count(F.lit(1)).alias("num_rows"),
                  F.coalesce(F.sum(sum(size[1:], size[0])), F.lit(0)).cast("bigint").alias("num_bytes"))


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    """Query result as CSV. CSV holds no structs: flatten nested columns first."""
    nested = [f.name for f in df.schema.fields
              if isinstance(f.dataType, T.StructType | T.ArrayType | T.MapType)]
    if nested:
        raise ValueError(f"flatten nested columns before CSV: {nested}")
    df.write.mode("errorifexists").option("header", str(header).lower()).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("header", str(header).lower()).csv(path)


def discard(df: DataFrame) -> None:
    """Run the whole plan and drop the output (the noop sink)."""
    df.write.format("noop").mode("overwrite").save()


__all__ = ["create_dataset", "describe_dataset", "read_source", "load_table", "describe_table",
           "schema_fields", "schema_json", "schema_frame", "table_stats", "write_csv", "read_csv", "discard",
           "storage_root"]
