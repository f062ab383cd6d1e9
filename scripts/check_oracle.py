"""Run registered queries against their DuckDB oracle: python scripts/check_oracle.py [sf_dir] [names...]"""

import json
import sys
import time

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__file__)))

from skyledger.plans import QUERIES  # noqa: E402
from skyledger.plans.check import compare, duckdb_connection  # noqa: E402
from skyledger.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(QUERIES)
spark = local_session()
con = duckdb_connection(sf)
bad = 0
for n in names:
    t = time.time()
    try:
        r = compare(spark, n, sf, con)
    except Exception as e:  # report and continue
        r = {"query": n, "status": "ERROR", "error": str(e)[:400]}
    r["sec"] = round(time.time() - t, 2)
    bad += r["status"] not in ("ok", "rows-only")
    print(json.dumps(r, default=str))
print(f"# {len(names) - bad}/{len(names)} ok")
