"""Health-check state from a probe log.

A probe succeeds when the target answered and within the timeout; a probe without an
answer or a latency (null) is a failure, one without a time does not count. Probes in the first ``initial_delay_s`` of an instance do not count. An instance
turns UNHEALTHY after ``unhealthy_threshold`` failures in a row and HEALTHY
after ``healthy_threshold`` successes in a row; otherwise it keeps its
state (UNKNOWN before the first decision).

Batch plan: three running scans over one keying and order, so ordinary instances take
one shuffle and a very busy one is split (see ``scan``):
1. position of each counted probe (probes that do not count have no part in what follows);
2. position of the last success and of the last failure so far: the current run is what
   lies behind the last probe of the other outcome;
3. a decisive mark where the run reaches its threshold, and the state as the last mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.scan import hot_keys, running
from skyledger.sources import literals

HC = literals.HEALTH_CHECK


def probe_outcomes(probes: DataFrame, timeout_s: float = HC["timeout_s"],
                   initial_delay_s: int = HC["initial_delay_s"]) -> DataFrame:
    """success = answered within the timeout; counted = after the initial delay. An instance's
    first probe time is a running minimum in time order, so a very busy instance is split."""
    d = running(probes, ["instance"], ["ts", "probe_id"], {"first_ts": ("min", F.col("ts"))})
    return d.select(
        "probe_id", "instance", "ts",
        _known(F.col("ok") & (F.col("latency_s") <= F.lit(float(timeout_s)))).alias("success"),
        _known(F.col("ts") >= F.col("first_ts") + F.expr(f"INTERVAL {int(initial_delay_s)} SECONDS")).alias("counted"))


def _known(condition: Column) -> Column:
    """The condition, false where it is unknown."""
    return F.coalesce(condition, F.lit(False))


def health_state(outcomes: DataFrame, healthy_threshold: int = HC["healthy_threshold"],
                 unhealthy_threshold: int = HC["unhealthy_threshold"]) -> DataFrame:
    """State after each probe (probe_id, instance, ts, success, counted, state). An unknown outcome
    (null) is a failure, an unknown ``counted`` does not count."""
    columns = ["probe_id", "instance", "ts", "success", "counted"]
    order = ["ts", "probe_id"]
    c = outcomes.select("probe_id", "instance", "ts", _known(F.col("success")).alias("success"),
                        _known(F.col("counted")).alias("counted"))
    scan = {"keys": ["instance"], "order": order, "hot": hot_keys(c, ["instance"], order)}
    counted, ok = F.col("counted"), F.col("success")
    c = running(c, aggs={"pos": ("sum", F.when(counted, F.lit(1).cast("bigint")))}, **scan)
    c = running(c, aggs={"last_ok": ("max", F.when(counted & ok, F.col("pos"))),
                         "last_fail": ("max", F.when(counted & ~ok, F.col("pos")))}, **scan)
    run_len = F.col("pos") - F.coalesce(F.when(ok, F.col("last_fail")).otherwise(F.col("last_ok")), F.lit(0))
    mark = (F.when(counted & ok & (run_len >= healthy_threshold), F.lit("HEALTHY"))
            .when(counted & ~ok & (run_len >= unhealthy_threshold), F.lit("UNHEALTHY")))
    c = running(c.withColumn("mark", mark), aggs={"state": ("last", F.col("mark"))}, **scan)
    return c.select(*columns, F.when(counted, F.coalesce(F.col("state"), F.lit("UNKNOWN")))
                    .otherwise(F.lit("UNKNOWN")).alias("state"))
