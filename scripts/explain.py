"""Print the formatted physical plan of query models.

usage: python scripts/explain.py [--sf DIR] name [name ...]

Shows what to look for at scale: PushedFilters / ReadSchema at the scans,
BroadcastHashJoin only for small sides, Exchange count, WholeStageCodegen
spans, WindowGroupLimit for rank filters.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.plans import MODELS  # noqa: E402
from starloom.session import get_spark  # noqa: E402
from starloom.sources.views import Mart  # noqa: E402


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="+")
    a = ap.parse_args()
    spark = get_spark("local[8]")
    mart = Mart(spark, a.sf)
    for name in a.names:
        print(f"==== {name}")
        MODELS[name](mart).explain("formatted")


if __name__ == "__main__":
    main()
