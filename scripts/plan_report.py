"""Plan audit: for every registered query, what all its executed plans contain.

Runs each query (noop sink) and reads the final plan of every SQL execution it caused,
those that stage intermediate tables or count keys included, from Spark's event log
(written to a fresh scratch folder): parquet scans, shuffle exchanges, joins, windows,
aggregates and Python nodes. Usage: python scripts/plan_report.py [sf_dir] [names...]
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile
from collections import Counter, defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from skyledger.plans import QUERIES  # noqa: E402
from skyledger.sources.catalog import discard  # noqa: E402

COUNTED = {
    "scans": r"Scan parquet", "exchanges": r"Exchange$", "round_robin": r"RoundRobin", "broadcasts": r"BroadcastExchange",
    "broadcast_joins": r"BroadcastHashJoin", "sort_merge_joins": r"SortMergeJoin",
    "nested_loop_joins": r"BroadcastNestedLoopJoin|CartesianProduct", "windows": r"Window$",
    "hash_aggregates": r"^HashAggregate", "sort_aggregates": r"^SortAggregate", "python_nodes": r"Python|Pandas|Arrow",
}


def nodes(info: dict):
    yield info["nodeName"], info["simpleString"]
    for child in info["children"]:
        yield from nodes(child)


def audit(plans: list[dict]) -> dict:
    out: Counter = Counter()
    for plan in plans:
        for name, text in nodes(plan):
            for what, pattern in COUNTED.items():
                out[what] += bool(re.search(pattern, text if what == "round_robin" else name))
    return {"executions": len(plans), **{what: out[what] for what in COUNTED}}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    logs = tempfile.mkdtemp(prefix="skyledger-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("plan-report")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logs)
             .config("spark.eventLog.compress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    for n in names:
        spark.sparkContext.setJobDescription(n)
        discard(QUERIES[n](spark, sf))
    spark.stop()

    owner: dict[int, str] = {}
    last: dict[int, dict] = {}
    for path in glob.glob(f"{logs}/**/*", recursive=True):
        if os.path.isfile(path):
            with open(path) as f:
                for line in f:
                    if "sparkPlanInfo" in line:
                        e = json.loads(line)
                        if "description" in e:
                            owner[e["executionId"]] = e["description"].split("\n")[0]
                        last[e["executionId"]] = e["sparkPlanInfo"]
    plans = defaultdict(list)
    for k, plan in last.items():
        plans[owner.get(k)].append(plan)
    for n in names:
        print(json.dumps({"query": n, **audit(plans[n])}))


if __name__ == "__main__":
    main()
