"""Per-key rate-limit breaches over a request stream.

Every micro-batch is counted per (key, tumbling epoch-aligned window), exactly as the
batch operator counts, and its counts are written as one folder of the sink, named by
the batch number: a batch that is retried after a failure replaces its own folder. A
window's count is the sum over the batches, so files may arrive in any order and late
requests are counted like any other; nothing is dropped behind a watermark and no state
is kept between batches. What grows is the sink, by one row per key and window of a
batch; ``compact`` rewrites it as one row per key and window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger.session import remove_path, scratch_path
from skyledger.sources import literals
from skyledger.sources.fixtures import EVENT_SCHEMA, requests_from_events

MAX_FILES_PER_TRIGGER = 1000


def event_stream(spark: SparkSession, directory: str, glob: str = "events*.parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Event files below ``directory/glob`` as a stream (explicit schema). The pattern may name
    files or folders of part files; a trigger takes a bounded number of files."""
    if not any(c in glob for c in "*?[{"):
        glob = f"{glob[:-1]}[{glob[-1]}]"  # as a pattern it may match one file or a folder alike
    return (spark.readStream.schema(EVENT_SCHEMA)
            .option("maxFilesPerTrigger", str(max_files_per_trigger or MAX_FILES_PER_TRIGGER))
            .parquet(f"{directory.rstrip('/')}/{glob}"))


def window_counts(requests: DataFrame, key: str, interval_s: int) -> DataFrame:
    return (requests.groupBy(F.col(key), F.window("ts", f"{int(interval_s)} seconds").alias("w"))
            .agg(F.count(F.lit(1)).alias("requests"))
            .select(key, F.col("w.start").alias("window_start"), "requests"))


def start_rate_limit_stream(requests: DataFrame, sink: str, checkpoint: str, key: str = "ip",
                            interval_s: int = literals.RATE_LIMIT["interval_s"],
                            available_now: bool = True) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        window_counts(batch, key, interval_s).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    w = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def _sums(counts: DataFrame, key: str) -> DataFrame:
    return counts.groupBy(key, "window_start").agg(F.sum("requests").alias("requests"))


def current_breaches(spark: SparkSession, sink: str, key: str = "ip",
                     limit: int = literals.RATE_LIMIT["count"]) -> DataFrame:
    """(key, window) over the limit, from all counts written so far."""
    return _sums(spark.read.parquet(sink), key).where(F.col("requests") > limit).select(
        key, "window_start", "requests")


def compact(spark: SparkSession, sink: str, through_batch: int, key: str = "ip") -> str:
    """Rewrite the counts of batches up to ``through_batch`` (none of them running) as one row per
    key and window, in a new sink that is returned; later batches are copied as they are."""
    old = spark.read.parquet(sink)
    path = scratch_path(spark, "streams", "compacted")
    _sums(old.where(F.col("batch") <= through_batch), key).write.parquet(f"{path}/batch={through_batch}")
    later = old.where(F.col("batch") > through_batch)
    later.write.mode("append").partitionBy("batch").parquet(path)
    remove_path(spark, sink)
    return path


def rate_limit_stream(spark: SparkSession, events_dir: str, limit: int, interval_s: int,
                      glob: str = "events*.parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the stream to the end of the available input and return the breaches."""
    root = scratch_path(spark, "streams", "rate_limit")
    sink, ckpt = f"{root}/sink", f"{root}/checkpoint"
    q = start_rate_limit_stream(requests_from_events(event_stream(spark, events_dir, glob, max_files_per_trigger)),
                                sink, ckpt, "ip", interval_s)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return current_breaches(spark, sink, "ip", limit)
