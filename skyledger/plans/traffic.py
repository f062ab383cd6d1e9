"""Contract queries: rate limits, replica sizing, cache keys, sampling, re-keying, health."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.operators import health as H
from skyledger.operators import rekey as R
from skyledger.operators import traffic as TR
from skyledger.plans.registry import register
from skyledger.sources import fixtures as fx

# The test data has at most a few requests per IP per minute, so the contract
# queries use a daily window and a limit of 2 to exercise both outcomes.
LIMIT, INTERVAL_S = 2, 86400
_WB = f"time_bucket(INTERVAL {INTERVAL_S} SECOND, ts, TIMESTAMP '1970-01-01')"


@register("rate_limit_breaches", f"""
SELECT ip, {_WB} AS window_start, COUNT(*) AS requests
FROM requests GROUP BY ip, {_WB} HAVING COUNT(*) > {LIMIT}""", ("requests",))
def rate_limit_breaches(spark, sf):
    return TR.rate_limit_breaches(fx.requests(spark, sf), "ip", "ts", LIMIT, INTERVAL_S)


@register("rate_limit_verdicts", f"""
SELECT request_id, ip, ts, window_start, position,
       CASE WHEN position <= {LIMIT} THEN 'allow' ELSE 'deny(403)' END AS verdict
FROM (SELECT request_id, ip, ts, {_WB} AS window_start,
             row_number() OVER (PARTITION BY ip, {_WB} ORDER BY ts, request_id) AS position
      FROM requests)""", ("requests",))
def rate_limit_verdicts(spark, sf):
    v = TR.rate_limit_verdicts(fx.requests(spark, sf), "ip", "ts", "request_id", LIMIT, INTERVAL_S)
    return v.select("request_id", "ip", "ts", "window_start", "position", "verdict")


# 10 requests per hour per instance at 0.8 target utilisation.
RR_INTERVAL, RR_RATE = 3600, 10 / 3600
_CAP = TR.capacity_per_instance(RR_INTERVAL, RR_RATE, 0.8, 1.0)
_RB = f"time_bucket(INTERVAL {RR_INTERVAL} SECOND, ts, TIMESTAMP '1970-01-01')"


@register("replica_recommendation", f"""
SELECT network, window_start, requests, needed, least(greatest(needed, 1), 2) AS recommended
FROM (SELECT network, {_RB} AS window_start, COUNT(*) AS requests,
             CAST(ceil(COUNT(*) / CAST({_CAP!r} AS DOUBLE)) AS INTEGER) AS needed
      FROM requests GROUP BY network, {_RB})""", ("requests",))
def replica_recommendation(spark, sf):
    return TR.replica_recommendation(fx.requests(spark, sf), "network", "ts", RR_INTERVAL, RR_RATE, 0.8, 1.0, 1, 2)


@register("replica_timeline", f"""
WITH busy AS (SELECT network, {_RB} AS window_start, COUNT(*) AS requests,
                     CAST(ceil(COUNT(*) / CAST({_CAP!r} AS DOUBLE)) AS INTEGER) AS needed
              FROM requests GROUP BY network, {_RB}),
     spans AS (SELECT network, min(window_start) AS a, max(window_start) AS b FROM busy GROUP BY network),
     every AS (SELECT network, unnest(generate_series(a, b, INTERVAL {RR_INTERVAL} SECOND)) AS window_start FROM spans)
SELECT e.network, e.window_start, COALESCE(b.requests, 0) AS requests, COALESCE(b.needed, 0) AS needed,
       least(greatest(COALESCE(b.needed, 0), 1), 2) AS recommended
FROM every e LEFT JOIN busy b ON e.network = b.network AND e.window_start = b.window_start""", ("requests",))
def replica_timeline(spark, sf):
    return TR.replica_timeline(fx.requests(spark, sf), "network", "ts", RR_INTERVAL, RR_RATE, 0.8, 1.0, 1, 2)


_P = "'^([A-Za-z][A-Za-z0-9+.-]*)://'"
_H = "'^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)'"
_PA = "'^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)'"


@register("requests_by_cache_key", f"""
SELECT protocol || '://' || host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS cache_key,
       COUNT(*) AS requests
FROM (SELECT regexp_extract(url, {_P}, 1) AS protocol, regexp_extract(url, {_H}, 1) AS host,
             regexp_extract(url, {_PA}, 1) AS path, regexp_extract(url, '\\?([^#]*)', 1) AS query
      FROM pages)
GROUP BY 1""")
def requests_by_cache_key(spark, sf):
    pages = fx.read_table(spark, sf, "pages")
    return TR.requests_by_cache_key(pages, "url", include_protocol=True, include_host=True, include_query=True)


SAMPLE_RATE = 0.25


@register("log_sample", f"""
SELECT request_id, ip, ts FROM requests
WHERE CAST(('0x' || substr(md5(CAST(request_id AS VARCHAR)), 1, 8)) AS BIGINT) < {int(SAMPLE_RATE * 4294967296)}""",
          ("requests",))
def log_sample(spark, sf):
    return TR.sample_logs(fx.requests(spark, sf).select("request_id", "ip", "ts"), "request_id", SAMPLE_RATE)


@register("rekey_roundtrip", """
SELECT doc_id, doc_id % 2 = 0 AS rewritten, doc_id % 2 = 0 AS readable,
       CASE WHEN doc_id % 2 = 0 THEN text END AS recovered,
       CASE WHEN doc_id % 2 = 0 THEN NULL ELSE text END AS recovered_old
FROM documents""")
def rekey_roundtrip(spark, sf):
    docs = fx.read_table(spark, sf, "documents").select("doc_id", "text")
    old, new = R.key_bytes("csek-old"), R.key_bytes("csek-new")
    enc = R.encrypt(docs, "text", old).drop("text")
    rot = R.rewrite(enc, "payload", old, new, F.col("doc_id") % 2 == 0)
    # what the rotation left under the old key is read with that
    rot = R.read_with(rot, "payload", old, out="recovered_old").drop("readable")
    return R.read_with(rot, "payload", new).select("doc_id", "rewritten", "readable", "recovered", "recovered_old")


_OUTCOMES = """
SELECT p.probe_id, p.instance, p.ts, COALESCE(p.ok AND p.latency_s <= 5.0, FALSE) AS success,
       COALESCE(p.ts >= f.first_ts + INTERVAL 60 SECOND, FALSE) AS counted
FROM probes p JOIN (SELECT instance, min(ts) AS first_ts FROM probes GROUP BY instance) f
  ON p.instance IS NOT DISTINCT FROM f.instance"""


@register("probe_outcomes", _OUTCOMES, ("probes",))
def probe_outcomes(spark, sf):
    return H.probe_outcomes(fx.probes(spark, sf))


HEALTH_SQL = f"""
WITH o AS ({_OUTCOMES}),
     c AS (SELECT * FROM o WHERE counted),
     r AS (SELECT *, row_number() OVER (PARTITION BY instance ORDER BY ts, probe_id)
                     - row_number() OVER (PARTITION BY instance, success ORDER BY ts, probe_id) AS grp
           FROM c),
     l AS (SELECT *, row_number() OVER (PARTITION BY instance, success, grp ORDER BY ts, probe_id) AS run_len
           FROM r),
     m AS (SELECT *, CASE WHEN success AND run_len >= 2 THEN 'HEALTHY'
                          WHEN NOT success AND run_len >= 2 THEN 'UNHEALTHY' END AS mark FROM l)
SELECT probe_id, instance, ts, success, counted,
       COALESCE(last_value(mark IGNORE NULLS) OVER (PARTITION BY instance ORDER BY ts, probe_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'UNKNOWN') AS state
FROM m
UNION ALL
SELECT probe_id, instance, ts, success, counted, 'UNKNOWN' AS state FROM o WHERE NOT counted"""


@register("health_state", HEALTH_SQL, ("probes",))
def health_state(spark, sf):
    return H.health_state(H.probe_outcomes(fx.probes(spark, sf)))
