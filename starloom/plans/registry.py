"""Registry of query models (S9) and their exposure as views or tables.

A model is ``fn(mart, **params) -> DataFrame``; models that read other
models simply call them, so dependency order falls out of lazy
evaluation and nothing runs until an action.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from ..operators.relational import sharing

MODELS: dict[str, Callable] = {}


def model(fn: Callable) -> Callable:
    """Registers a query model; sub-plans it shares live as long as its result."""

    @wraps(fn)
    def run(mart, **params):
        return sharing(lambda: fn(mart, **params))

    MODELS[fn.__name__] = run
    return run


def build_models(mart, names=None, **params) -> dict:
    """Lazy DataFrames of the named models (all when ``names`` is None)."""
    return {n: MODELS[n](mart, **params.get(n, {})) for n in (names or sorted(MODELS))}


def register_models(mart, names=None, prefix: str = "", mode: str = "view", path: str | None = None) -> list[str]:
    """Expose models as temp views (``mode='view'``) or parquet tables under ``path``."""
    import os

    from ..sources.views import materialize

    out = []
    for name, df in build_models(mart, names).items():
        target = os.path.join(path, prefix + name) if path else None
        materialize(df, prefix + name, mode, target)
        out.append(prefix + name)
    return out
