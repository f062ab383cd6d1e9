"""Text files and logs as ordered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(path, line_no 1-based, n_lines, line) for every line of every file.

    Files are read in splits, so a large file is many tasks' work and no row
    holds more than a line. A split keeps its lines in order; a line's number is
    its place in the split plus the lines of the file's earlier splits. Lines end
    at a line feed; a trailing one does not make an extra empty line.
    """
    r = spark.read.option("lineSep", "\n")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    lines = r.text(path).select(F.col("_metadata.file_path").alias("path"),
                                F.col("_metadata.file_block_start").alias("block"),
                                F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))
    blocks = lines.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    whole = Window.partitionBy("path")
    before = blocks.select("path", "block", "first", F.sum("n").over(whole).alias("n_lines"),
                           (F.sum("n").over(whole.orderBy("block")) - F.col("n")).alias("before"))
    return lines.join(before, ["path", "block"]).select(
        "path", (F.col("before") + F.col("place") - F.col("first") + 1).alias("line_no"), "n_lines", "line")


def tail(lines: DataFrame, n: int) -> DataFrame:
    """The last ``n`` lines of each file (``tail -n``)."""
    return lines.where(F.col("line_no") > F.col("n_lines") - n)


def head(lines: DataFrame, n: int) -> DataFrame:
    """The first ``n`` lines of each file (``head -n``)."""
    return lines.where(F.col("line_no") <= n)
