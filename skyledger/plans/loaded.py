"""The billing table, loaded from an export file as the lab's load step does.

The billing export is derived (a five-way join), written as an export file in
parquet, and loaded from that file into a table whose schema comes from the file; the
billing queries then scan the table, so their filters reach the parquet reader
(``PushedFilters: GreaterThan(cost, …)``) and only the struct fields they use are read.
Every source folder has a table of its own. It carries a stamp of the files it was derived
from (names, lengths, modification times) and is loaded again when any of them has changed,
as a new version: results of the version before stay readable.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession

from skyledger.session import remove_path, scratch_path
from skyledger.sources import catalog as C
from skyledger.sources.avro import register_avro
from skyledger.sources.fixtures import billing

DATASET, TABLE = "billing_lab", "billing_export"
SOURCES = ("lineitem", "orders", "part", "supplier", "customer", "nation")
_LOCK = threading.Lock()


def _stamp(spark: SparkSession, sf: str) -> str:
    root = sf.rstrip("/")
    return f"billing:{root}:" + C.source_stamp(spark, [f"{root}/{t}.parquet" for t in SOURCES])


def billing_name(sf: str) -> str:
    """The table of one source folder."""
    return f"{TABLE}_{hashlib.md5(sf.rstrip('/').encode()).hexdigest()[:12]}"


def _load(spark: SparkSession, sf: str, stamp: str) -> str:
    export = scratch_path(spark, "exports", "billing")
    billing(spark, sf).write.mode("errorifexists").option("compression", "zstd").parquet(export)
    name = C.load_table(spark, export, DATASET, billing_name(sf), fmt="parquet", mode="overwrite", source_tag=stamp)
    remove_path(spark, export)
    return name


def load_billing(spark: SparkSession, sf: str) -> str:
    """Load the table from ``sf`` now, whatever it holds."""
    with _LOCK:
        return _load(spark, sf, _stamp(spark, sf))


def load_billing_avro(spark: SparkSession, sf: str) -> str:
    """Load the billing table of ``sf`` from an export in Avro container files, as the lab's load does."""
    export = scratch_path(spark, "exports", "billing_avro")
    billing(spark, sf).write.format(register_avro(spark)).mode("append").save(export)
    name = C.load_table(spark, export, DATASET, f"{billing_name(sf)}_avro", fmt="avro", mode="overwrite")
    remove_path(spark, export)
    return name


def billing_table_name(spark: SparkSession, sf: str) -> str:
    """The billing table of ``sf`` as its files are now; loaded if it is missing or stale."""
    name = f"{DATASET}.{billing_name(sf)}"
    with _LOCK:
        stamp = _stamp(spark, sf)
        return name if C.loaded_from(spark, name) == stamp else _load(spark, sf, stamp)


def billing_table(spark: SparkSession, sf: str) -> DataFrame:
    return spark.table(billing_table_name(spark, sf))
