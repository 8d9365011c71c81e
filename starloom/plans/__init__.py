"""Query models: one function per analytical query, DataFrame API only.

``MODELS`` maps a query id (``q01`` ... ``q99``, with ``a``/``b``
variants) to ``fn(mart, **params) -> DataFrame``.  Every literal of a
query is a keyword parameter whose default is the query's own value.
"""

from .registry import MODELS, model  # noqa: F401
from . import q00s, q10s, q20s, q30s, q40s, q50s, q60s, q70s, q80s  # noqa: F401,E402
