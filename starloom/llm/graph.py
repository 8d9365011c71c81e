"""Connected components of a distributed edge list."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stored


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("_m"))


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, smallest vertex of its component) of the edges (u, v), for vertices other than the smallest."""
    ids, place = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = place[: len(u)], place[len(u):]
    label = np.arange(len(ids))
    while len(a):
        x, y = label[a], label[b]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))  # x and y are roots
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    below = label != np.arange(len(ids))
    return ids[below], ids[label[below]]


def _forests(batches):
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if held:
        u, v = forest(*(np.concatenate(x) for x in zip(*held)))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def connected_components(edges: DataFrame, max_rounds: int = 60, block: int = 1 << 20) -> DataFrame:
    """(id, component) for every vertex of the undirected edges (a, b), a written table: the smallest id reachable.

    Alternates the large-star step (a vertex hands its larger neighbours to its
    smallest neighbour) and the small-star step (likewise its smaller ones) until
    the edge list stops changing; it is then a star around every component's
    smallest id.  A vertex of any degree costs only its edges: minima are
    aggregated with partial sums and joined back, no neighbour list is gathered.
    Each round is written to the shared folder, so lineage stays short; a graph
    that needs more than ``max_rounds`` rounds is an error, not a wrong answer.
    As soon as at most ``block`` edges are left (16 MB by default) one task ends
    the work, with the same result."""

    def stars(now: DataFrame) -> DataFrame:
        return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
            now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())

    def ended(now: DataFrame) -> DataFrame:
        return stars(stored(now.coalesce(1).mapInArrow(_forests, "u long, v long"), "forest"))

    now = (edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")).filter("u <> v")
           .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    if now.count() <= block:
        return ended(now)
    now = stored(now.distinct(), "edges")
    mark = None
    for k in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_minima(both), "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "_m").alias("v")).distinct())
        small = large.join(_minima(large), "u")
        now = stored(small.select(F.explode(F.array(
            F.struct(F.col("u"), F.col("_m").alias("v")), F.struct(F.col("v").alias("u"), F.col("_m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u <> v").distinct(), f"round{k}")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        if seen[0] <= block:
            return ended(now)
        mark = tuple(seen)
    else:
        raise RuntimeError("connected components did not settle")
    return stars(now)
