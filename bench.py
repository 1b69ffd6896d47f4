"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (all rows computed,
nothing collected to the driver). The domain tables are derived once per
session (timed as ``derive_tables``, part of the total). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from probscope.plans.registry import queries
    from probscope.session import local_session
    from probscope.sources.fixtures import load_tables

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          app="probscope-bench")
    t0 = time.perf_counter()
    load_tables(spark, sf_dir)
    timings = {"derive_tables": round(time.perf_counter() - t0, 3)}

    registry = queries()
    names = only or sorted(registry)
    total = timings["derive_tables"]
    for name in names:
        t0 = time.perf_counter()
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        dt = time.perf_counter() - t0
        timings[name] = round(dt, 3)
        total += dt
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(total, 3), "unit": "sec",
                      "queries": timings, "sf": sf, "n_queries": len(names), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
