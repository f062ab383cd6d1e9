"""Contract queries run as Structured Streaming jobs over the events table.

Both read events as a file stream, run to the end of the available input
(``availableNow``) and must equal the batch operators on in-order data, so
they share the batch oracles.
"""

from __future__ import annotations

from skyledger.plans.registry import register
from skyledger.plans.traffic import _WB, HEALTH_SQL, INTERVAL_S, LIMIT
from skyledger.streaming.health import health_stream as _health_stream
from skyledger.streaming.rate_limit import rate_limit_stream as _rate_limit_stream


@register("rate_limit_stream", f"""
SELECT ip, {_WB} AS window_start, COUNT(*) AS requests
FROM requests GROUP BY ip, {_WB} HAVING COUNT(*) > {LIMIT}""", ("requests",))
def rate_limit_stream(spark, sf):
    return _rate_limit_stream(spark, sf, LIMIT, INTERVAL_S, glob="events.parquet")


@register("health_stream", HEALTH_SQL, ("probes",))
def health_stream(spark, sf):
    return _health_stream(spark, sf, glob="events.parquet")
