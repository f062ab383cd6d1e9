"""Monte Carlo estimate of pi, as a distributed aggregate.

Each row supplies one point of the unit square drawn from the MD5 of its
key (repeatable and identical in any SQL engine). The count of points
inside the quarter circle is a plain partial/final aggregate, so the job
scales with the number of rows and the number of tasks, like the
1,000-task example job the cluster lab submits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TWO32 = 4294967296.0


def _unit(hexpart: Column) -> Column:
    return F.conv(hexpart, 16, 10).cast("bigint") / F.lit(_TWO32)


def unit_point(key: Column) -> tuple[Column, Column]:
    """(x, y) in [0, 1) from the first and second 32 bits of md5(key)."""
    h = F.md5(key.cast("string"))
    return _unit(F.substring(h, 1, 8)), _unit(F.substring(h, 9, 8))


def pi_estimate(df: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """4 * (points inside the quarter circle) / points, one point per row."""
    if tasks:
        df = df.repartition(tasks)
    x, y = unit_point(F.col(key))
    inside = F.when(x * x + y * y <= F.lit(1.0), F.lit(1)).otherwise(F.lit(0))
    return (df.select(inside.alias("inside"))
            .agg(F.count(F.lit(1)).alias("points"), F.sum("inside").alias("inside"))
            .select("points", "inside",
                    (F.lit(4.0) * F.col("inside") / F.col("points")).alias("pi_estimate")))


def pi_job(spark: SparkSession, tasks: int = 1000, points_per_task: int = 100000) -> DataFrame:
    """The example job itself: `tasks` slices of generated ids (library use; the
    registered query draws its points from table rows instead)."""
    n = tasks * points_per_task
    return pi_estimate(spark.range(0, n, 1, tasks), "id")
