"""Side-by-side check of a Spark result against its DuckDB oracle.

Same column names, same row count, same multiset of rows (floats
compared after rounding to 6 places).  Used by the tests and by
``scripts/compare.py``.
"""

from __future__ import annotations

import math
import os

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else f"{round(v, 6):.6f}"
    if type(v).__name__ == "Decimal":
        return f"{float(v):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return str(v)


def canonical_rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(df, con, sql: str) -> tuple[bool, str, int]:
    """(equal, message, spark row count) of a Spark DataFrame vs an oracle SQL text."""
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: spark={scols} oracle={dcols}", len(srows)
    if len(srows) != len(drows):
        return False, f"row counts differ: spark={len(srows)} oracle={len(drows)}", len(srows)
    a, b = canonical_rows(scols, srows), canonical_rows(dcols, drows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {diff}", len(srows)
    return True, "OK", len(srows)
