"""Registry of oracle SQL texts."""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def ob(keys: str, cols: str, n: int | None = 100) -> str:
    """ORDER BY the given keys, then every other output column; LIMIT n.

    ``keys`` and ``cols`` are comma-separated; a key may end in DESC.
    """
    key_list = [k.strip() for k in keys.split(",") if k.strip()]
    used = {k.split()[0] for k in key_list}
    parts = [k if "NULLS" in k.upper() else k + " NULLS LAST" for k in key_list]
    names = [y.strip().split(" AS ")[-1].strip() for y in cols.split(",")]
    parts += [f"{x} NULLS LAST" for x in names if x and x not in used]
    out = "ORDER BY " + ", ".join(parts)
    return out + (f"\nLIMIT {n}" if n else "")


def register(**texts: str) -> None:
    ORACLE.update(texts)
