"""Shared preparation of vector tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of rows that take part: id and vector not null, every component finite.
    A repeated id counts once, with its smallest vector."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                           F.col(vector).cast("array<double>").alias("vector"))
            .filter(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)))
            .groupBy("vec_id").agg(F.min("vector").alias("vector")))


def smallest_copies(vectors: DataFrame, vector: str, keep: int) -> DataFrame:
    """Of the rows that share one vector, those of the ``keep`` smallest ids. Copies score alike and
    ties go to smaller ids, so for k results beside a query's own row ``keep = k + 1`` loses
    nothing, however large a group of copies is. Spark limits each group before its shuffle."""
    rank = F.row_number().over(Window.partitionBy(vector).orderBy("vec_id"))
    return vectors.withColumn("__copy", rank).filter(F.col("__copy") <= keep).drop("__copy")


def best(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each query, ties to smaller ids."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

