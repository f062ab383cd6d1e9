"""Session helpers: a local session for tests/bench and the shared storage root."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_ARROW_KEY, _ARROW_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
ARROW_BATCH = "2m"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "skyledger") -> SparkSession:
    """Session for tests and the local bench. On a cluster, use the cluster's
    session; none of the operators depend on these settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SKYLEDGER_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    storage_root(spark)
    return spark


def storage_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only on a ``local`` master may it be unset (tests);
    then a fresh scratch folder is created and registered. On a cluster a folder
    of one machine would lose data, so a missing setting is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                                   f"executors share (master is {sc.master})")
            root = tempfile.mkdtemp(prefix="skyledger-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A unique path below the storage root for written intermediate tables."""
    root = storage_root(spark).rstrip("/")
    return "/".join([root, *parts, uuid.uuid4().hex])


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result as parquet under the shared storage root and
    read it back. This cuts the lineage: later steps that use the result more than
    once read files instead of recomputing it, and a lost executor costs a
    re-read, not a recomputation. Runs a job now."""
    spark = df.sparkSession
    path = scratch_path(spark, "stages", label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written table below the storage root (any file system Spark reads)."""
    if not path.startswith(storage_root(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is not below the storage root")
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor.

    Functions that run in workers are pickled by reference, so the workers must
    be able to import the package. It is zipped once per session and handed to
    ``addPyFile``; Spark serves it to the executors. Arrow batches of texts are kept at
    ``ARROW_BATCH`` unless the session sets a size: a batch is held by the JVM and by
    the worker at once.
    """
    sc = spark.sparkContext
    if spark.conf.get(_ARROW_KEY, None) == _ARROW_DEFAULT:
        spark.conf.set(_ARROW_KEY, ARROW_BATCH)
    if getattr(sc, "_skyledger_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="skyledger-py-"), "skyledger_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    sc._skyledger_shipped = True
