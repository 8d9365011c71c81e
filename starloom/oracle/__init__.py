"""Independent SQL formulation of every query model, for DuckDB.

The texts reference mart tables by name; :func:`starloom.sources.mart.oracle`
prepends the mart definitions as CTEs.  They are a second implementation
of each query, used only to check the DataFrame models.
"""

from .registry import ORACLE, ob  # noqa: F401
from . import q00s, q10s, q20s, q30s, q40s, q50s, q60s, q70s, q80s  # noqa: F401,E402
