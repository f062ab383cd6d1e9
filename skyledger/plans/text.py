"""Contract queries: column functions over document lines, URLs and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.functions import text as X
from skyledger.operators.compute import pi_estimate
from skyledger.plans.registry import register
from skyledger.sources import fixtures as fx
from skyledger.sources import literals as L

LINE_PATTERN = "(License|token)"


@register("regex_filter", f"""
SELECT doc_id, line_no, line FROM doc_lines WHERE regexp_matches(line, '{LINE_PATTERN}')""",
          ("doc_lines",))
def regex_filter(spark, sf):
    lines = fx.doc_lines(spark, sf)
    return lines.where(X.regex_match(F.col("line"), LINE_PATTERN)).select("doc_id", "line_no", "line")


@register("zone_to_region", """
SELECT name, zone, regexp_replace(zone, '-[^-]*$', '') AS region FROM instances""", ("instances",))
def zone_to_region(spark, sf):
    inst = fx.instances(spark, sf)
    return inst.select("name", "zone", X.zone_to_region(F.col("zone")).alias("region"))


@register("nth_field", """
SELECT page_id, split_part(url, '/', 4) AS path_head,
       COALESCE(string_split_regex(regexp_replace(html, '^\\s+|\\s+$', '', 'g'), '\\s+')[5], '') AS word5
FROM pages""")
def nth_field(spark, sf):
    pages = fx.read_table(spark, sf, "pages")
    return pages.select("page_id", X.nth_field(F.col("url"), "/", 4).alias("path_head"),
                        X.nth_word(F.col("html"), 5).alias("word5"))


@register("concat_names", f"""
SELECT c_custkey, 'proj-' || CAST(c_custkey AS VARCHAR) || '{L.BACKUP_BUCKET_SUFFIX}' AS bucket,
       '{L.SERVICE_ACCOUNT_NAME}@proj-' || CAST(c_custkey AS VARCHAR) || '{L.SERVICE_ACCOUNT_DOMAIN}'
           AS service_account
FROM customer""")
def concat_names(spark, sf):
    c = fx.read_table(spark, sf, "customer")
    proj = F.concat(F.lit("proj-"), c.c_custkey.cast("string"))
    return c.select("c_custkey", F.concat(proj, F.lit(L.BACKUP_BUCKET_SUFFIX)).alias("bucket"),
                    F.concat(F.lit(L.SERVICE_ACCOUNT_NAME + "@"), proj,
                             F.lit(L.SERVICE_ACCOUNT_DOMAIN)).alias("service_account"))


@register("default_if_empty", """
SELECT page_id, COALESCE(NULLIF(COALESCE(regexp_extract(url, '\\?([^#]*)', 1), ''), ''), '-') AS query
FROM pages""")
def default_if_empty(spark, sf):
    pages = fx.read_table(spark, sf, "pages")
    q = F.regexp_extract(F.col("url"), r"\?([^#]*)", 1)
    return pages.select("page_id", X.default_if_empty(q, "-").alias("query"))


@register("timestamp_key", """
SELECT event_id, strftime(ts, '%Y%m%d-%H%M%S') AS ts_key FROM events""")
def timestamp_key(spark, sf):
    ev = fx.read_table(spark, sf, "events")
    return ev.select("event_id", X.timestamp_key(F.col("ts")).alias("ts_key"))


@register("base64_key", """
SELECT c_custkey, trim(to_base64(unhex(sha256(CAST(c_custkey AS VARCHAR))))) AS csek_key FROM customer""")
def base64_key(spark, sf):
    c = fx.read_table(spark, sf, "customer")
    return c.select("c_custkey", X.base64_key(F.col("c_custkey")).alias("csek_key"))


@register("regex_replace", """
SELECT doc_id, line_no,
       regexp_replace(regexp_replace(regexp_replace(line,
           '^Licensed under', 'Released under', 'g'),
           'License\\.$', 'Licence.', 'g'),
           'token = ".*', 'token = "<rotated>"', 'g') AS edited
FROM doc_lines""", ("doc_lines",))
def regex_replace(spark, sf):
    lines = fx.doc_lines(spark, sf)
    e = X.replace_at_start(F.col("line"), "Licensed under", "Released under")
    e = X.replace_at_end(e, "License.", "Licence.")
    e = X.replace_rest(e, 'token = "', 'token = "<rotated>"')
    return lines.select("doc_id", "line_no", e.alias("edited"))


@register("byte_size", """
SELECT doc_id, n_chars, CAST(strlen(text) AS BIGINT) AS n_bytes FROM documents""")
def byte_size(spark, sf):
    d = fx.read_table(spark, sf, "documents")
    return d.select("doc_id", "n_chars", X.byte_size(F.col("text")).cast("bigint").alias("n_bytes"))


@register("last_n_lines", """
SELECT doc_id, line_no, line FROM doc_lines WHERE line_no > n_lines - 50""", ("doc_lines",))
def last_n_lines(spark, sf):
    return X.last_line_rows(fx.read_table(spark, sf, "documents"), "text", 50, "doc_id")


@register("first_line", """
SELECT doc_id, split_part(text, chr(10), 1) AS first_line FROM documents""")
def first_line(spark, sf):
    d = fx.read_table(spark, sf, "documents")
    return d.select("doc_id", X.first_line(F.col("text")).alias("first_line"))


@register("drop_last_5_lines", """
SELECT doc_id, array_to_string(list_slice(parts, 1, greatest(len(parts) - 5, 0)), chr(10)) AS kept
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)""")
def drop_last_5_lines(spark, sf):
    d = fx.read_table(spark, sf, "documents")
    return d.select("doc_id", X.drop_last_lines(F.col("text"), 5).alias("kept"))


@register("pi_estimate", """
SELECT CAST(COUNT(*) AS BIGINT) AS points, CAST(SUM(inside) AS BIGINT) AS inside,
       CAST(4.0 AS DOUBLE) * SUM(inside) / COUNT(*) AS pi_estimate
FROM (SELECT CASE WHEN x * x + y * y <= CAST(1.0 AS DOUBLE) THEN 1 ELSE 0 END AS inside
      FROM (SELECT CAST(('0x' || substr(h, 1, 8)) AS BIGINT) / CAST(4294967296.0 AS DOUBLE) AS x,
                   CAST(('0x' || substr(h, 9, 8)) AS BIGINT) / CAST(4294967296.0 AS DOUBLE) AS y
            FROM (SELECT md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS h
                  FROM lineitem)))""")
def pi(spark, sf):
    li = fx.read_table(spark, sf, "lineitem")
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in
                             ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return pi_estimate(li.select(key.alias("k")), "k")
