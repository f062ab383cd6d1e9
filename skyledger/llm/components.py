"""Connected components of an undirected graph by alternating large and small stars.

Each round joins every node to the smallest neighbour seen, so a component of any
shape shrinks to a star in about log² rounds. A round is two hash aggregations and two
equi-joins on the node; a hub's rows are pre-aggregated before the shuffle and its join
side is unique, so a skewed hub can be split. Every round is written to the shared
storage root, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import remove_path, scratch_path


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return (both.filter("v > u").join(low, "u").filter("v <> low")
            .select(F.col("v").alias("u"), F.col("low").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("low"))
    moved = down.join(low, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(low.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: bigint, u <> v, no nulls); the root is
    the smallest node of the component and stands for itself too."""
    spark = edges.sparkSession

    def written(df, label):
        path = scratch_path(spark, "components", label)
        df.write.mode("errorifexists").parquet(path)
        return spark.read.parquet(path), path

    def print_of(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    current, path = written(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    seen = print_of(current)
    while seen[0]:
        star, star_path = written(_small_star(_large_star(current)), "star")
        remove_path(spark, path)
        now = print_of(star)
        current, path = star, star_path
        if now == seen:
            break
        seen = now
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
