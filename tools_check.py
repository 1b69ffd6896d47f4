"""Dev helper: compare registered Spark queries with their DuckDB oracles.

usage: python tools_check.py [sf_dir] [name ...]
"""
import json
import sys
import time

from probscope.plans.oracle import oracle_sql
from probscope.plans.registry import queries
from tests.verify import compare, duck
from probscope.session import local_session

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(queries())
    spark = local_session(8)
    con = duck(sf_dir)
    orc = oracle_sql()
    bad = 0
    for n in names:
        t0 = time.time()
        if n not in orc:
            df = queries()[n](spark, sf_dir)
            print(json.dumps({"name": n, "rows_only": df.count(), "sec": round(time.time() - t0, 2)}))
            continue
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "ok": False, "error": repr(e)[:800]}
        r["sec"] = round(time.time() - t0, 2)
        bad += not r.get("ok")
        print(json.dumps(r, default=str))
    print("FAILED", bad)
