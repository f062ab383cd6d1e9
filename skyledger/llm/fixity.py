"""Merkle fixity audit of archived web records.

Every record is a leaf: the hash of its offset, length and content digest. Leaves whose
offsets fall into one range of ``SPAN`` bytes hash, in offset order, into a node; ``FANOUT``
neighbouring ranges hash into a node of the next level, up to one root per archive. Two
replicas are audited by comparing roots and going down, level by level, only below nodes
that differ; the leaves reached that way are the damaged records. Nothing else of the
replicas is compared, and payloads are read once, to be hashed.

Scale: keys are (archive, range), so neither a large archive nor a large replica is one
task; a node has at most FANOUT children, and a range at most SPAN leaves (records have at
least one byte). Each level is written to the shared storage root and is a fraction of the
one below. Offsets come from prefix sums in two steps, over slices of an archive and within
them, so an archive or a record id that holds most rows is split.

Defined results: null columns of a page count as empty text; a null page_id is archived
under archive -1; repeated rows are one run of copies, audited as one leaf; very long pages
are hashed whole; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.registry import register, table
from skyledger.session import stage_table

ARCHIVE_RECORDS = 1024
SPAN = 1 << 16
FANOUT = 16


# ---------------------------------------------------------------- records
def record(page_id: Column, url: Column, html: Column) -> Column:
    """A page as the text of one WARC response record."""
    def text(c):
        return F.coalesce(c.cast("string"), F.lit(""))

    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <page:"), text(page_id),
                    F.lit(">\r\nWARC-Target-URI: "), text(url), F.lit("\r\nContent-Length: "),
                    F.octet_length(text(html)).cast("string"), F.lit("\r\n\r\n"), text(html), F.lit("\r\n\r\n"))


def manifest(records: DataFrame, carry: list[str]) -> DataFrame:
    """Lays out (archive, record_id, length, digest, and the columns ``carry``, which the digest
    determines) end to end in each archive, in order of record_id and digest: adds copies (equal
    rows) and offset (of the first copy)."""
    runs = (records.groupBy("archive", "record_id", "length", "digest")
            .agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in carry])
            .withColumn("slice", F.substring("digest", 1, 2)))
    size = F.col("length") * F.col("copies")
    slices = runs.groupBy("archive", "record_id", "slice").agg(F.sum(size).alias("bytes"))
    before = F.sum("bytes").over(Window.partitionBy("archive").orderBy("record_id", "slice")) - F.col("bytes")
    key = F.struct("archive", "record_id", "slice").alias("key")
    base = slices.select(key, before.alias("base"))
    inner = F.sum(size).over(Window.partitionBy("key").orderBy("digest", "length")) - size
    return (runs.withColumn("key", key).withColumn("inner", inner).join(base, "key")
            .withColumn("offset", F.col("base") + F.col("inner")).drop("key", "slice", "inner", "base"))


# ------------------------------------------------------------------- tree
def _node(child: str, digest: str) -> Column:
    """Hash of the children's places and hashes, in order."""
    return F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(child, digest))), lambda c: F.concat(
        c[child].cast("string"), F.lit(":"), c[digest])), ","), 256)


def tree(leaves: DataFrame, span: int = SPAN, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of the trees of all replicas from (replica, archive, offset, leaf): (replica, archive,
    node, hash), the finest first; the last has one root per replica and archive."""
    top = leaves.agg(F.max("offset")).first()[0]
    if top is None:
        return []
    finest = leaves.withColumn("node", F.expr(f"offset div {span}")).groupBy("replica", "archive", "node").agg(
        _node("offset", "leaf").alias("hash"))
    levels, nodes = [stage_table(finest, "merkle")], top // span
    while nodes:
        nodes //= fanout
        above = (levels[-1].withColumnRenamed("node", "child").withColumn("node", F.expr(f"child div {fanout}"))
                 .groupBy("replica", "archive", "node").agg(_node("child", "hash").alias("hash")))
        levels.append(stage_table(above, "merkle"))
    return levels


def _differing(nodes: DataFrame, keys: list[str], digest: str, carry: list[str]) -> DataFrame:
    """Keys whose digest differs between replicas 0 and 1 (or is missing in one)."""
    side = [F.max(F.when(F.col("replica") == r, F.col(digest))).alias(f"digest_{r}") for r in (0, 1)]
    both = nodes.groupBy(*keys).agg(*side, *[F.max(c).alias(c) for c in carry])
    return both.filter(~F.col("digest_0").eqNullSafe(F.col("digest_1")))


def audit(primary: DataFrame, replica: DataFrame, span: int = SPAN, fanout: int = FANOUT) -> DataFrame:
    """Damaged records of ``replica`` against ``primary``. Both have archive and offset (their key,
    not null), record_id, length, copies, digest. Returns these with status (``altered``: the leaves differ;
    ``lost``: not in the replica; ``stray``: only there) and both leaf hashes."""
    columns = ["archive", "offset", "record_id", "length", "copies", "digest"]
    leaf = F.sha2(F.concat_ws(":", *[F.col(c).cast("string") for c in ("offset", "length", "copies", "digest")]), 256)
    sides = [df.select(F.lit(r).alias("replica"), *columns).withColumn("leaf", leaf)
             for r, df in enumerate((primary, replica))]
    leaves = stage_table(sides[0].union(sides[1]), "merkle_leaves")
    levels = tree(leaves, span, fanout)
    frontier = None
    for nodes in reversed(levels):
        if frontier is not None:
            above = frontier.select("archive", F.col("node").alias("above"))
            nodes = (nodes.withColumn("above", F.expr(f"node div {fanout}"))
                     .join(above, ["archive", "above"], "left_semi"))
        frontier = stage_table(_differing(nodes, ["archive", "node"], "hash", []), "merkle_frontier")
    if frontier is not None:
        leaves = (leaves.withColumn("node", F.expr(f"offset div {span}"))
                  .join(frontier.select("archive", "node"), ["archive", "node"], "left_semi"))
    found = _differing(leaves, ["archive", "offset"], "leaf", ["record_id", "length", "copies"])
    status = (F.when(F.col("digest_1").isNull(), "lost").when(F.col("digest_0").isNull(), "stray").otherwise("altered"))
    return found.select("archive", "offset", "record_id", "length", "copies", status.alias("status"),
                        F.col("digest_0").alias("primary_leaf"), F.col("digest_1").alias("replica_leaf"))


# ------------------------------------------------------------------ query
#: The replica of the query: which records it has lost, and in which the last byte is damaged.
LOST, ALTERED = "page_id % 101 = 7", "page_id % 97 = 5"


@register("op1_merkle_fixity", f"""
WITH texts AS (
  SELECT page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
      || 'WARC-Record-ID: <page:' || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10)
      || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
      || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10)
      || coalesce(html, '') || chr(13) || chr(10) || chr(13) AS head
  FROM pages),
runs AS (
  SELECT coalesce(page_id // {ARCHIVE_RECORDS}, -1) AS archive, page_id, strlen(head) + 1 AS length,
         sha256(head || chr(10)) AS digest, sha256(head || chr(13)) AS damaged, count(*) AS copies
  FROM texts GROUP BY ALL),
laid AS (
  SELECT *, CAST(sum(length * copies) OVER (PARTITION BY archive ORDER BY page_id NULLS FIRST, digest)
                 - length * copies AS BIGINT) AS "offset" FROM runs),
judged AS (
  SELECT *, CASE WHEN {LOST} THEN 'lost' WHEN {ALTERED} THEN 'altered' END AS status FROM laid),
leafs AS (
  SELECT *, sha256(concat_ws(':', "offset", length, copies, digest)) AS primary_leaf,
         CASE WHEN status = 'altered' THEN sha256(concat_ws(':', "offset", length, copies, damaged)) END AS replica_leaf
  FROM judged WHERE status IS NOT NULL)
SELECT archive, "offset", page_id, length, copies, status, primary_leaf, replica_leaf FROM leafs""")
def op1_merkle_fixity(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    page_id = F.col("page_id").cast("long")
    whole = record(page_id, F.col("url"), F.col("html"))
    damaged = F.concat(F.regexp_replace(whole, r"\n\z", ""), F.lit("\r"))
    records = pages.select(
        F.coalesce(F.expr(f"cast(page_id as long) div {ARCHIVE_RECORDS}"), F.lit(-1)).cast("long").alias("archive"),
        page_id.alias("record_id"), F.octet_length(whole).cast("long").alias("length"),
        F.sha2(whole, 256).alias("digest"), F.sha2(damaged, 256).alias("damaged"))
    laid = stage_table(manifest(records, ["damaged"]).withColumn("page_id", F.col("record_id")), "manifest")
    lost, altered = F.coalesce(F.expr(LOST), F.lit(False)), F.coalesce(F.expr(ALTERED), F.lit(False))
    replica = laid.filter(~lost).withColumn("digest", F.when(altered, F.col("damaged")).otherwise(F.col("digest")))
    return audit(laid, replica).withColumnRenamed("record_id", "page_id")
