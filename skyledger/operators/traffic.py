"""Request-log analytics: per-key rate limits, replica sizing, cache keys, sampling.

Windows are epoch-aligned tumbling windows (``F.window``), the same in batch
and in Structured Streaming.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.network import policy_first_match
from skyledger.operators.scan import running
from skyledger.sources import literals


def _interval(seconds: int) -> str:
    return f"{int(seconds)} seconds"


def backend_settings(policy_json: str = literals.BACKEND_SERVICE_JSON) -> dict:
    """Settings of a backend-service document that the request operators use:
    cache-key policy, log sample rate, and the rate-based backend's capacity."""
    doc = json.loads(policy_json)
    key = doc.get("cdnPolicy", {}).get("cacheKeyPolicy", {})
    rate = next((b for b in doc.get("backends", []) if b.get("balancingMode") == "RATE"), {})
    return {
        "cache_key": {"include_protocol": bool(key.get("includeProtocol", True)),
                      "include_host": bool(key.get("includeHost", True)),
                      "include_query": bool(key.get("includeQueryString", True))},
        "sample_rate": float(doc.get("logConfig", {}).get("sampleRate", 1.0)),
        "max_rate_per_instance": float(rate.get("maxRatePerInstance", literals.AUTOSCALER["max_rate_per_instance"])),
        "capacity_scaler": float(rate.get("capacityScaler", literals.AUTOSCALER["capacity_scaler"])),
    }


BACKEND = backend_settings()


def rate_limit_breaches(requests: DataFrame, key: str = "ip", ts: str = "ts",
                        limit: int = literals.RATE_LIMIT["count"],
                        interval_s: int = literals.RATE_LIMIT["interval_s"]) -> DataFrame:
    """(key, window) whose request count exceeds the limit."""
    g = requests.groupBy(F.col(key), F.window(F.col(ts), _interval(interval_s)).alias("w")) \
        .agg(F.count(F.lit(1)).alias("requests"))
    return g.where(F.col("requests") > limit).select(
        key, F.col("w.start").alias("window_start"), "requests")


def rate_limit_verdicts(requests: DataFrame, key: str = "ip", ts: str = "ts", id_col: str = "request_id",
                        limit: int = literals.RATE_LIMIT["count"],
                        interval_s: int = literals.RATE_LIMIT["interval_s"],
                        exceed_action: str = literals.RATE_LIMIT["exceed_action"]) -> DataFrame:
    """Conforming requests are allowed; the ones past the limit in their
    (key, window) get the exceed action. The position of a request in its
    window is a running count, by a scan that splits a very busy key along
    time (no time zone is involved)."""
    w = F.window(F.col(ts), _interval(interval_s))
    d = requests.withColumn("window_start", w.start)
    d = running(d, [key, "window_start"], [ts, id_col], {"position": ("sum", F.lit(1))})
    return d.withColumn("verdict", F.when(F.col("position") <= limit, F.lit("allow"))
                        .otherwise(F.lit(exceed_action)))


def policy_verdicts(requests: DataFrame, policy_json: str = literals.SECURITY_POLICY_JSON, key: str = "ip",
                    ts: str = "ts", id_col: str = "request_id") -> DataFrame:
    """Verdicts of a whole request policy: a request gets the action of its first matching rule;
    only those that the throttle rule matches are counted against that rule's limit. Adds
    rule_priority, rule_action and verdict (no rule: NULL)."""
    rule = literals.throttle(policy_json)
    matched = policy_first_match(requests, key, policy_json)
    throttled = F.col("rule_priority").eqNullSafe(F.lit(rule["priority"])) & (F.col("rule_action") == "throttle")
    limited = rate_limit_verdicts(matched.where(throttled), key, ts, id_col, rule["count"], rule["interval_s"],
                                  rule["exceed_action"])
    others = matched.where(~F.coalesce(throttled, F.lit(False))).withColumn("verdict", F.col("rule_action"))
    columns = [*matched.columns, "verdict"]
    return limited.select(columns).unionByName(others.select(columns))


def replica_recommendation(load: DataFrame, group: str, ts: str, interval_s: int = 60,
                           max_rate_per_instance: float = BACKEND["max_rate_per_instance"],
                           target_utilization: float = literals.AUTOSCALER["target_utilization"],
                           capacity_scaler: float = BACKEND["capacity_scaler"],
                           min_replicas: int = literals.AUTOSCALER["min_replicas"],
                           max_replicas: int = literals.AUTOSCALER["max_replicas"]) -> DataFrame:
    """Replicas per (group, window) so that requests / (replicas * capacity) stays at
    or below the target utilisation; clamped to [min, max]."""
    capacity = capacity_per_instance(interval_s, max_rate_per_instance, target_utilization, capacity_scaler)
    g = load.groupBy(F.col(group), F.window(F.col(ts), _interval(interval_s)).alias("w")) \
        .agg(F.count(F.lit(1)).alias("requests"))
    need = F.ceil(F.col("requests") / F.lit(capacity)).cast("int")
    rec = F.least(F.greatest(need, F.lit(min_replicas)), F.lit(max_replicas))
    return g.select(group, F.col("w.start").alias("window_start"), "requests",
                    need.alias("needed"), rec.alias("recommended"))


def replica_timeline(load: DataFrame, group: str, ts: str, interval_s: int = 60,
                     max_rate_per_instance: float = BACKEND["max_rate_per_instance"],
                     target_utilization: float = literals.AUTOSCALER["target_utilization"],
                     capacity_scaler: float = BACKEND["capacity_scaler"],
                     min_replicas: int = literals.AUTOSCALER["min_replicas"],
                     max_replicas: int = literals.AUTOSCALER["max_replicas"]) -> DataFrame:
    """``replica_recommendation`` for every window between a group's first and last request: one
    without requests needs none, and gets the minimum. Counts are made once per window; the windows
    between are made from one row per group."""
    busy = replica_recommendation(load.where(F.col(ts).isNotNull()), group, ts, interval_s, max_rate_per_instance,
                                  target_utilization, capacity_scaler, min_replicas, max_replicas)
    span = busy.groupBy(F.col(group).alias("__group")).agg(F.min("window_start").alias("a"), F.max("window_start").alias("b"))
    every = span.select("__group", F.explode(F.sequence("a", "b", F.expr(f"INTERVAL {_interval(interval_s)}"))).alias("__start"))
    met = every.join(busy, F.col("__group").eqNullSafe(F.col(group)) & (F.col("__start") == F.col("window_start")), "left")
    least = min(max(0, min_replicas), max_replicas)
    return met.select(F.col("__group").alias(group), F.col("__start").alias("window_start"),
                      F.coalesce("requests", F.lit(0)).cast("long").alias("requests"),
                      F.coalesce("needed", F.lit(0)).alias("needed"), F.coalesce("recommended", F.lit(least)).alias("recommended"))


def capacity_per_instance(interval_s, max_rate_per_instance, target_utilization, capacity_scaler) -> float:
    cap = float(max_rate_per_instance) * float(interval_s) * float(target_utilization) * float(capacity_scaler)
    if not math.isfinite(cap) or cap <= 0:
        raise ValueError("capacity must be positive")
    return cap


def url_parts(url: Column) -> dict[str, Column]:
    return {
        "protocol": F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1),
        "host": F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1),
        "path": F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1),
        "query": F.regexp_extract(url, r"\?([^#]*)", 1),
    }


def cache_key(url: Column, include_protocol: bool = True, include_host: bool = True,
              include_query: bool = True) -> Column:
    """CDN cache key: path, plus protocol, host and query string as configured."""
    p = url_parts(url)
    parts = []
    if include_protocol:
        parts += [p["protocol"], F.lit("://")]
    if include_host:
        parts.append(p["host"])
    parts.append(p["path"])
    if include_query:
        parts.append(F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise(F.lit("")))
    return F.concat(*parts)


def requests_by_cache_key(df: DataFrame, url: str = "url", **policy: bool) -> DataFrame:
    """Requests per cache key; the key policy defaults to the backend document's."""
    flags = {**BACKEND["cache_key"], **policy}
    return df.groupBy(cache_key(F.col(url), **flags).alias("cache_key")).agg(
        F.count(F.lit(1)).alias("requests"))


def sample_logs(df: DataFrame, id_col: str, rate: float | None = None) -> DataFrame:
    """Keep a repeatable fraction of log rows: the first 32 bits of md5(id)
    below rate * 2^32 (rate 1.0 keeps everything; default: the backend's
    configured log sample rate)."""
    rate = BACKEND["sample_rate"] if rate is None else rate
    if rate >= 1.0:
        return df
    h = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("bigint")
    return df.where(h < F.lit(int(rate * 4294967296)))
