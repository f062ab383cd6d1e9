"""Hot-key evidence: largest per-task shuffle read, plain window vs running scan.

A grant log is derived from the events table with one key (member,
resource, role) owning a third of all rows, once with its dense sequence and once
with a sparse one. The same "last action before each row" is computed (a) with a
plain window partitioned by key and (b) with ``operators.scan.running`` at its
default settings; a third case, ``deep``, sets the bucket size so low that the key needs more
buckets than one cut makes, so it is cut twice. The per-task shuffle records are taken from Spark's event log, written to a
fresh scratch folder. Usage: python scripts/skew_report.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from skyledger.operators.network import salted_left_join  # noqa: E402
from skyledger.operators.scan import FAN, hot_keys, running  # noqa: E402
from skyledger.sources import fixtures as fx  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="skyledger-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("skew-report")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", logdir).config("spark.eventLog.compress", "false").config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.enabled", "false")  # fixed partitions: compare like with like
             .getOrCreate())
    hot = F.col("seq") % 3 == 0
    base = fx.grants(spark, sf).select(
        "seq", "action",
        F.when(hot, F.lit(0)).otherwise(F.col("member")).alias("member"),
        F.when(hot, F.lit("bucket-0")).otherwise(F.col("resource")).alias("resource"),
        F.when(hot, F.lit("roles/viewer")).otherwise(F.col("role")).alias("role"))
    total = base.count()
    same = True
    deep_rows = total // 3 * 2 // (2 * FAN)
    for kind, seq in (("dense", F.col("seq")), ("sparse", F.col("seq") * F.col("seq") * 131_071), ("deep", F.col("seq"))):
        g = base.withColumn("seq", seq)
        act = F.struct("seq", "action")
        spark.sparkContext.setJobGroup(f"plain_{kind}", "plain window")
        w = Window.partitionBy("member", "resource", "role").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
        plain = g.select("*", F.last(act, True).over(w).alias("last_act"))
        plain.write.format("noop").mode("overwrite").save()

        spark.sparkContext.setJobGroup(f"scan_{kind}", "running scan")
        keys = ["member", "resource", "role"]
        found = hot_keys(g, keys, ["seq"], deep_rows if kind == "deep" else None)
        scan = running(g, keys, ["seq"], {"last_act": ("last", act)}, exclusive=True, hot=found)
        if kind == "deep":
            levels = len(found.levels)
        scan.write.format("noop").mode("overwrite").save()
        spark.sparkContext.setJobGroup("check", "compare results")
        same &= plain.select("seq", "last_act").exceptAll(scan.select("seq", "last_act")).count() == 0
    # a third of the connections come from one machine; shuffled joins, no help at run time
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    conns = fx.connections(spark, sf).withColumn("src", F.when(F.col("order_key") % 3 == 0, "vm-c1").otherwise(F.col("src")))
    place = fx.instances(spark, sf).selectExpr("name AS src", "subnet")
    for how, joined in (("plain", conns.join(place, "src", "left")), ("salted", salted_left_join(conns, place, "src"))):
        spark.sparkContext.setJobGroup(f"join_{how}", f"{how} join")
        joined.write.format("noop").mode("overwrite").save()
    spark.stop()

    per_group: dict[str, list[int]] = {f"{how}_{kind}": [] for how in ("plain", "scan") for kind in ("dense", "sparse", "deep")}
    per_group |= {"join_plain": [], "join_salted": []}
    stage_group: dict[int, str] = {}
    for path in sorted(glob.glob(f"{logdir}/**/*", recursive=True)):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    grp = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = grp
                elif kind == "SparkListenerTaskEnd":
                    grp = stage_group.get(ev.get("Stage ID"))
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    if grp in per_group:
                        per_group[grp].append(m.get("Total Records Read", 0))
    report = {"rows": total, "hot_key_share": round(1 / 3, 3), "results_equal": same,
              "deep": {"hot_rows": deep_rows, "levels": levels, "fan": FAN},
              "max_shuffle_records_per_task": {k: max(v or [0]) for k, v in per_group.items()},
              "event_log": logdir}
    print(json.dumps(report))


if __name__ == "__main__":
    main()
