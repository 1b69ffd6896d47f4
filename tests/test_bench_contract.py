import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="confusion_last_best,probhist")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert d["unit"] == "sec" and d["sf"] == "0.001" and set(d["queries"]) >= {"confusion_last_best", "probhist"}
    assert d["value"] > 0
