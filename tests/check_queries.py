"""python tests/check_queries.py [sf_dir] [name ...]: time queries and compare them with their SQL."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

import __spark_entry__ as e  # noqa: E402
from conftest import local_session  # noqa: E402
from oracle import connect, differences  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = local_session()
con = connect(sf_dir)
sql = e.oracle_sql()
bad = 0
for name, run in e.queries().items():
    if len(sys.argv) > 2 and name not in sys.argv[2:]:
        continue
    t = time.time()
    try:
        df = run(spark, sf_dir)
        found = differences(df, con, sql[name]) if name in sql else [f"no SQL, {df.count()} rows"]
    except Exception as failure:  # noqa: BLE001
        found = [f"{type(failure).__name__}: {str(failure)[:600]}"]
    bad += bool(found) and name in sql
    print(f"{'ok ' if not found else '-- '}{name} {time.time() - t:.2f}s {' | '.join(found)}", flush=True)
print("bad:", bad)
