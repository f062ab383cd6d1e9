"""Immutable versions of a loaded table.

A load writes a version folder of its own and then an entry of the table's manifest; nothing
that a reader may hold is ever rewritten. The manifest has one small Parquet folder per
version (number, files' folder, source tag, time, rows), so entries never compete for a file.
The newest entry is the current version; a reader that has resolved a version keeps reading
its files whatever is loaded later. ``remove_old`` deletes versions that were replaced longer
ago than an age, so files outlive the results that may still read them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.session import remove_path, storage_root

MANIFEST_SCHEMA = "version string, path string, source_tag string, loaded_at timestamp_ntz, num_rows long"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _folder(spark: SparkSession, dataset: str, table: str) -> str:
    return f"{storage_root(spark).rstrip('/')}/warehouse/{dataset}/{table}"


def new_version(spark: SparkSession, dataset: str, table: str) -> tuple[str, str]:
    """A fresh version number (they sort by time) and its folder, not written yet."""
    version = f"{_now():%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    return version, f"{_folder(spark, dataset, table)}/versions/{version}"


def publish(spark: SparkSession, dataset: str, table: str, version: str, path: str, source_tag: str | None = None) -> None:
    """Enter a written version into the manifest; from now on it is the current one."""
    n = spark.read.parquet(path).count()
    row = spark.createDataFrame([(version, path, source_tag, _now(), n)], MANIFEST_SCHEMA)
    row.coalesce(1).write.mode("errorifexists").parquet(f"{_folder(spark, dataset, table)}/manifest/{version}")


def versions(spark: SparkSession, dataset: str, table: str) -> DataFrame:
    """The manifest of a table (a catalogue listing), with when each version was replaced."""
    folder = f"{_folder(spark, dataset, table)}/manifest"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath):
        rows = spark.createDataFrame([], MANIFEST_SCHEMA)
    else:
        rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/*")
    later = F.lead("loaded_at").over(Window.partitionBy(F.lit(table)).orderBy("version"))  # one row a version
    return rows.withColumn("replaced_at", later)


def read_version(spark: SparkSession, dataset: str, table: str, version: str | None = None) -> DataFrame:
    """The rows of one version, or of the current one. The result stays on that version."""
    known = versions(spark, dataset, table)
    known = known.filter(F.col("replaced_at").isNull() if version is None else F.col("version") == version)
    found = known.first()
    if found is None:
        raise ValueError(f"{dataset}.{table} has no version {version or 'yet'}")
    return spark.read.parquet(found.path)


def remove_old(spark: SparkSession, dataset: str, table: str, older_than_s: float, now: dt.datetime | None = None) -> list[str]:
    """Delete versions that were replaced more than ``older_than_s`` seconds before ``now``; returns
    their numbers. The current version is never deleted."""
    limit = (now or _now()) - dt.timedelta(seconds=older_than_s)
    gone = versions(spark, dataset, table).filter(F.col("replaced_at") <= F.lit(limit)).collect()  # a catalogue
    for r in gone:
        remove_path(spark, f"{_folder(spark, dataset, table)}/manifest/{r.version}")
        remove_path(spark, r.path)
    return [r.version for r in gone]
