"""Models and tables as a graph, written in dependency order.

A node names what it reads and builds its frame from those frames.  ``run`` writes
every wanted node, and what they need, once each; a node reads the written rows of
the nodes before it, so a shared node is computed once however many read it.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from ..sources.views import materialize
from .registry import MODELS


@dataclass(frozen=True)
class Node:
    """``build(frames)`` gets the frames of ``reads`` by name.  A node that is not ``written`` is
    handed on as it is: its rows lie in a table already."""

    build: Callable[[dict[str, DataFrame]], DataFrame]
    reads: tuple[str, ...] = ()
    written: bool = True


def dependency_order(nodes: dict[str, Node], wanted: Iterable[str]) -> list[str]:
    """The wanted nodes and all they need, each after what it reads.

    An unknown name is a ``KeyError`` that says who reads it; a cycle is a ``ValueError`` that names it.
    """
    needed: dict[str, tuple[str, ...]] = {}
    todo = [(name, None) for name in wanted]
    while todo:
        name, reader = todo.pop()
        if name not in nodes:
            raise KeyError(f"{name!r} is no node" + (f", but {reader!r} reads it" if reader else ""))
        if name not in needed:
            needed[name] = nodes[name].reads
            todo += [(r, name) for r in nodes[name].reads]
    try:
        return list(TopologicalSorter(needed).static_order())
    except CycleError as e:
        raise ValueError("models read each other: " + " -> ".join(reversed(e.args[1]))) from None


def run(spark: SparkSession, nodes: dict[str, Node], wanted: Iterable[str], path: str) -> dict[str, DataFrame]:
    """Writes the wanted nodes and what they need under ``path`` and returns all their frames.

    Tables are swapped in whole, so a run that failed half way can be repeated.
    """
    frames: dict[str, DataFrame] = {}
    for name in dependency_order(nodes, wanted):
        node = nodes[name]
        df = node.build({r: frames[r] for r in node.reads})
        frames[name] = materialize(df, name, "table", os.path.join(path, name)) if node.written else df
    return frames


class _Tables:
    """Tables by attribute, as models read them; the names that were read are kept in order."""

    def __init__(self, get: Callable[[str], DataFrame]):
        self._get, self._read = get, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = self._get(name)
        return self._read[name]


def _model_node(name: str, mart, params: dict) -> Node:
    seen = _Tables(mart.table)
    MODELS[name](seen, **params)  # a lazy frame: only tells which tables the model reads
    return Node(lambda frames: MODELS[name](_Tables(frames.__getitem__), **params), tuple(seen._read))


def model_graph(mart, names: Iterable[str], **params) -> dict[str, Node]:
    """Nodes of the named models (``params``: keyword parameters by model) and of the mart tables they read.

    A table is written once if two or more of the models read it and the mart is not
    written yet; otherwise models read the mart's own frame.
    """
    nodes = {n: _model_node(n, mart, params.get(n, {})) for n in names}
    readers: dict[str, int] = {}
    for node in nodes.values():
        for t in node.reads:
            readers[t] = readers.get(t, 0) + 1
    for t, n in readers.items():
        nodes[t] = Node(lambda _frames, t=t: mart.table(t), (), n > 1 and not mart.materialized)
    return nodes


def run_models(mart, names: Iterable[str], path: str, **params) -> dict[str, DataFrame]:
    """Writes the named models under ``path``, tables that several of them read first and once."""
    names = list(names)
    frames = run(mart.spark, model_graph(mart, names, **params), names, path)
    return {n: frames[n] for n in names}
