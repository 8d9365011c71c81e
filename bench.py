"""Benchmark: run every query model on the retail mart derived from $BENCH_SF_DIR.

Prints one JSON line:
  {"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

The mart is first written once as parquet under the session's checkpoint
folder (facts sorted by date key inside files), as a deployment would do before
serving many queries; its build time is reported as ``mart_build``.
Each query is then collected once after one warm-up run of the first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.plans import MODELS  # noqa: E402
from starloom.session import ensure_checkpoint_dir, get_spark  # noqa: E402
from starloom.sources.views import Mart, materialize_mart  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus))
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")

    t0 = time.time()
    ckpt = ensure_checkpoint_dir(spark)
    mart_dir = os.path.join(ckpt, "mart-" + Mart(spark, sf_dir).suffix)
    materialize_mart(spark, sf_dir, mart_dir)
    build = time.time() - t0
    mart = Mart(spark, mart_dir)

    names = only or sorted(MODELS)
    MODELS[names[0]](mart).collect()  # warm-up: JIT, file listing, codegen caches
    times = {}
    for name in names:
        t1 = time.time()
        MODELS[name](mart).collect()
        times[name] = round(time.time() - t1, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "mart_build": round(build, 3),
                      "total_with_build": round(total + build, 3), "sf": sf}))


if __name__ == "__main__":
    main()
