"""Line dedup with levelled sorted runs of line hashes.

A text is split at line ends. A line's key is the line without ASCII white space at both
ends, A-Z in lower case. A key of ``min_chars`` code points or more that several documents
hold loses all its lines except in the document of smallest doc_id that holds it.

``LineRuns`` is what is known of the lines so far: runs of (two 64-bit key hashes, owner),
each a table bucketed and sorted by the hashes, and every key in exactly one run. Batches
are added in doc_id order. A batch's keys are counted (with partial counts before the
shuffle), written with the bucketing of the runs, and merge-anti-joined with one run after
the other; what no run holds becomes a new run of the lowest level. Neither side of these
joins is shuffled. When a level has ``fanout`` runs they are compacted into one run of the
next level, so a batch meets at most ``fanout - 1`` runs of each level and a key is
rewritten once a level.

A line goes if its key is of an earlier batch, or if a smaller doc_id of its own batch holds
it. Lines meet the contested keys alone by a merge join on the hashes; the lines of frequent
keys (there are at most four to a bucket, by their share of the batch's lines) are decided by
a broadcast of these keys and are not shuffled, so one line in a third of all documents
crowds no task. Positions of dropped lines are gathered per document and cut out of the text
by slices between them.

Defined results: a null or empty text is one empty line; rows that share a doc_id are one
document for the rule, and each comes back with its own lines; a null doc_id counts as the
largest bigint; extra columns are ignored; an empty table gives no rows. Two different keys
are taken for one only if both 64-bit hashes agree.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.registry import register, table
from skyledger.session import remove_path, scratch_path, stage_table, storage_root

MIN_CHARS = 10
BATCHES = 4
FANOUT = 2
HOT_LINES = 256  # a key with fewer lines in a batch is never broadcast
WHITE = " \t\n\x0b\x0c\r"
LAST_ID = (1 << 63) - 1
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """Levels of sorted runs; ``add`` takes the next batch. ``close`` drops the runs."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT):
        storage_root(spark)
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _write(self, rows: DataFrame, label: str) -> str:
        name = f"llm_lines_{label}_{uuid.uuid4().hex}"
        self.paths[name] = scratch_path(self.spark, "lines", label)
        (rows.write.option("path", self.paths[name]).bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .saveAsTable(name))
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_path(self.spark, self.paths.pop(name))

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, lines: DataFrame, n_lines: int) -> DataFrame:
        """``lines`` (h1, h2, doc, text_hash, pos) of documents behind all that were added before:
        adds their keys and returns (doc, text_hash, dropped), the sorted positions of dropped lines."""
        keys = self._write(lines.groupBy(*KEY).agg(F.min("doc").alias("owner"), F.max("doc").alias("last"),
                                                   F.count("*").alias("n")), "batch")
        batch = self.spark.table(keys)
        fresh = batch.select(*KEY, "owner")
        for run in self.runs():
            fresh = fresh.join(self.spark.table(run).select(*KEY).hint("merge"), KEY, "left_anti")
        new = self._write(fresh, "run")
        owned = self.spark.table(new).select(*KEY, F.lit(True).alias("fresh"))
        contested = (batch.join(owned.hint("merge"), KEY, "left").filter("fresh is null or owner < last")
                     .select(*KEY, "n", F.when(F.col("fresh"), F.col("owner")).alias("owner")))
        dropped = stage_table(self._dropped(lines, contested, n_lines), "line_drops")
        self._drop(keys)
        self._push(new, 0)
        return dropped

    def _dropped(self, lines: DataFrame, contested: DataFrame, n_lines: int) -> DataFrame:
        frequent = F.col("n") >= max(HOT_LINES, -(-n_lines // (4 * self.buckets)))
        few = F.broadcast(contested.filter(frequent).select(
            *KEY, F.col("owner").alias("few_owner"), F.lit(True).alias("few")))  # at most 4 to a bucket
        marked = lines.join(few, KEY, "left")
        place = ["doc", "text_hash", "pos"]
        hot = marked.filter("few and (few_owner is null or doc > few_owner)").select(*place)
        cold = (marked.filter("few is null").select(*KEY, *place)
                .join(contested.filter(~frequent).select(*KEY, "owner").hint("merge"), KEY)
                .filter("owner is null or doc > owner").select(*place))
        return hot.union(cold).groupBy("doc", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("dropped"))

    def _push(self, run: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) < self.fanout:
            return
        old, self.levels[level] = self.levels[level], []
        merged = self.spark.table(old[0])
        for name in old[1:]:
            merged = merged.union(self.spark.table(name))
        compact = self._write(merged.repartition(self.buckets, *KEY), "run")
        for name in old:
            self._drop(name)
        self._push(compact, level + 1)

    def close(self) -> None:
        for name in list(self.paths):
            self._drop(name)
        self.levels = []


def cut_lines(lines: Column, dropped: Column) -> Column:
    """The lines without those at the sorted positions ``dropped``: the slices between them."""
    def kept(k):
        first = F.when(k == 0, 1).otherwise(F.get(dropped, k - 1) + 2)
        last = F.when(k == F.size(dropped), F.size(lines)).otherwise(F.get(dropped, k))
        return F.slice(lines, first, last - first + 1)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(dropped)), kept))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES,
                        fanout: int = FANOUT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_lines, n_dropped and the ``kept`` text."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("doc", F.coalesce("doc_id", F.lit(LAST_ID))).withColumn("text_hash", F.xxhash64("text"))
    cuts = rows.agg(F.percentile_approx("doc", [i / batches for i in range(1, batches)])).first()[0] or []
    number = sum([(F.col("doc") > c).cast("int") for c in sorted(set(cuts))], F.lit(0))
    key = line_key(F.col("line"))
    lines = (rows.select("doc", "text_hash", number.alias("batch"), F.posexplode(text_lines(F.col("text"))).alias("pos", "line"))
             .select("doc", "text_hash", "batch", "pos", key.alias("key"))
             .filter(F.char_length("key") >= min_chars)
             .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"),
                     "doc", "text_hash", "pos", "batch"))
    path = scratch_path(spark, "stages", "lines")
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("h1 long, h2 long, doc long, text_hash long, pos int, batch int").parquet(path)
    sizes = {r["batch"]: r["n"] for r in lines.groupBy("batch").agg(F.count("*").alias("n")).collect()}  # one row a batch
    runs, dropped = LineRuns(spark, fanout=fanout), []
    try:
        for b in sorted(sizes):
            dropped.append(runs.add(lines.filter(F.col("batch") == b).drop("batch"), sizes[b]))
    finally:
        runs.close()
    remove_path(spark, path)
    if not dropped:
        return rows.select("doc_id", F.size(text_lines(F.col("text"))).cast("long").alias("n_lines"),
                           F.lit(0).cast("long").alias("n_dropped"), F.col("text").alias("kept"))
    found = dropped[0]
    for more in dropped[1:]:
        found = found.union(more)
    met = (rows.join(found, ["doc", "text_hash"], "left")
           .select("doc_id", "text", "dropped", text_lines(F.col("text")).alias("lines")))
    return met.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                      F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                      F.when(F.col("dropped").isNull(), F.col("text")).otherwise(
                          F.array_join(cut_lines(F.col("lines"), F.col("dropped")), "\n")).alias("kept"))


@register("op13_line_dedup", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, COALESCE(doc_id, {LAST_ID}) AS doc,
                  string_split(COALESCE(text, ''), chr(10)) AS lines FROM documents),
     l AS (SELECT r, doc_id, doc, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
     k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                               '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
     o AS (SELECT key, min(doc) AS owner FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key),
     m AS (SELECT k.*, COALESCE(doc > owner, FALSE) AS gone FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE gone) AS n_dropped,
       sha256(COALESCE(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id""")
def op13_line_dedup(spark, sf_dir):
    return drop_repeated_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
