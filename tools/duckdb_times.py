"""Time each oracle SQL in DuckDB (single node, all cores) at one scale.

Usage: python tools/duckdb_times.py [sf_dir]
A single-node reference point for bench.py (the original project publishes
no numbers of its own).
"""

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main():
    import duckdb

    from linedocs.plans.catalog import ORACLE_SQL

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in ("documents", "events", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    times = {}
    for name, sql in ORACLE_SQL.items():
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            con.execute(f"CREATE OR REPLACE TEMP TABLE _bench AS {sql}")
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    print(json.dumps({"engine": "duckdb", "sf_dir": sf, "total": round(sum(times.values()), 3),
                      "queries": times}))


if __name__ == "__main__":
    main()
