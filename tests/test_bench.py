"""bench.py prints the single JSON line the driver records."""

import json
import os
import subprocess
import sys

from conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_QUERIES="q42,q96")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900, check=True).stdout.strip().splitlines()
    doc = json.loads(out[-1])
    assert doc["metric"] == "total_query_seconds" and doc["unit"] == "sec"
    assert set(doc["queries"]) == {"q42", "q96"} and doc["value"] > 0 and doc["sf"] == "0.001"
