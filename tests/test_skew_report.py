"""The hot-key claim, checked from Spark's event log in a separate process."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_scan_splits_a_hot_key():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "scripts", "skew_report.py"), "/root/testdata/sf0.1"],
                         capture_output=True, text=True, timeout=600, check=True).stdout
    report = json.loads(out.strip().splitlines()[-1])
    assert report["results_equal"]
    most, mean = report["max_shuffle_records_per_task"], report["rows"] / 16
    for kind in ("dense", "sparse"):
        assert most[f"plain_{kind}"] >= report["rows"] // 3   # a plain window puts the hot key in one task
        assert most[f"scan_{kind}"] <= 2.5 * mean             # the scan, at its defaults, does not
