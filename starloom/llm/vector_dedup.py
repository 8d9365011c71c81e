"""Embedding near-dedup by an inverted multi-index.

Two codebooks, trained independently on the halves of a bounded sample of unit
vectors, form a product grid of K * K cells; every vector is indexed in the cell
of its two nearest centroids, within its label.  Every vector is also a query:
the multi-sequence order visits cells by the sum of the two half distances,
and goes on for as many cells as cover ``recall`` of partners at the
threshold itself, measured on random directions around a bounded sample of
queries (closer partners are covered better).  What is found is verified by
the cosine in double precision.

Equal vectors of a label collapse to one first.  Cells are cut into blocks of at
most about ``BLOCK`` vectors, queries likewise; blocks meet in a join on (label,
cell), which adaptive execution splits at a hot cell, and a pair of blocks is one
matrix product.  A pair of blocks returns link counts and a spanning set of its
links (every vector with the smallest member of its part), never the pairs.
A link counts for both vectors, whichever of them visits the other's cell.

Defined results
* null label; null, empty or zero vector; null or non-finite component: linked with nothing,
  n_links 0, a component of its own.
* vectors of different lengths are never linked.
* n_links counts other rows' vectors linked directly; a repeated (vec_id, label, embedding) row is one vector.
* rows with null vec_id take part and never name a component unless all of it have none.
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded_sample, stored
from starloom.llm.graph import connected_components

BLOCK = 512


def _distances(a: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((a ** 2).sum(axis=1)[:, None] - 2 * a @ centroids.T + (centroids ** 2).sum(axis=1), 0)


def codebook(a: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """k-means centroids; an empty cluster keeps its centroid."""
    c = a[np.random.default_rng(seed).choice(len(a), k, replace=len(a) < k)].copy()
    for _ in range(rounds):
        near = _distances(a, c).argmin(axis=1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, a)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[:, : x.shape[1] // 2], x[:, x.shape[1] // 2:]


class Grid:
    """Two codebooks and the number of cells a query visits."""

    def __init__(self, sample: np.ndarray, k: int, threshold: float, recall: float, seed: int = 5):
        first, second = _halves(sample)
        self.books = codebook(first, k), codebook(second, k)
        self.k = k
        rng = np.random.default_rng(seed)
        q = sample[:500]
        u = rng.standard_normal(q.shape)
        u -= (u * q).sum(axis=1, keepdims=True) * q
        u /= np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-12)
        y = threshold * q + np.sqrt(1 - threshold ** 2) * u
        ranks = np.empty(len(q), np.int64)
        for i in range(len(q)):
            d1, d2 = (_distances(h, b)[0] for h, b in zip(_halves(q[i:i + 1]), self.books))
            own = sum(d[_distances(h, b)[0].argmin()] for d, h, b in zip((d1, d2), _halves(y[i:i + 1]), self.books))
            ranks[i] = (np.searchsorted(np.sort(d2), own - d1, "left")).sum()
        self.visits = int(min(k * k, np.quantile(ranks, recall) + 1))

    def cell(self, x: np.ndarray) -> np.ndarray:
        return sum(_distances(h, b).argmin(axis=1) * m for h, b, m in zip(_halves(x), self.books, (self.k, 1)))

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The first ``visits`` cells of each query in multi-sequence order: by sum of half distances.
        The cell of the a-th and b-th nearest centroids comes after (a+1)(b+1)-1 others at least."""
        d1, d2 = (_distances(h, b) for h, b in zip(_halves(x), self.books))
        o1, o2 = d1.argsort(axis=1, kind="stable"), d2.argsort(axis=1, kind="stable")
        a, b = np.divmod(np.arange(self.k * self.k), self.k)
        early = (a + 1) * (b + 1) <= self.visits
        a, b = a[early], b[early]
        s1, s2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
        total = s1[:, a] + s2[:, b]
        take = np.argsort(total, axis=1, kind="stable")[:, : self.visits]
        return np.take_along_axis(o1, a[take], 1) * self.k + np.take_along_axis(o2, b[take], 1)


def unit(raw: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(v, np.float64) for v in raw])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _placed(grid):
    """Each vector with its own cell and the cells its query visits."""

    def run(batches):
        g = grid.value
        for batch in batches:
            if not len(batch):
                continue
            raw = batch.column(2).to_pylist()
            cells, visits = np.zeros(len(raw), np.int64), [np.zeros(0, np.int64)] * len(raw)
            width = np.array([len(v) for v in raw])
            for w in np.unique(width):
                rows = np.flatnonzero(width == w)
                if w // 8 != sum(b.shape[1] for b in g.books):
                    visits = [np.array([-w]) if i in set(rows.tolist()) else v for i, v in enumerate(visits)]
                    cells[rows] = -w  # vectors of another length than the grid's: one cell for each length
                    continue
                for s in range(0, len(rows), 1024):
                    part = rows[s:s + 1024]
                    x = unit([raw[i] for i in part])
                    cells[part] = g.cell(x)
                    for i, v in zip(part.tolist(), g.nearest(x)):
                        visits[i] = v
            at = np.concatenate(([0], np.cumsum([len(v) for v in visits]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells), pa.ListArray.from_arrays(at, np.concatenate(visits).astype(np.int64))],
                                             names=[*batch.schema.names, "cell", "visits"])

    return run


def _met(threshold: float):
    """Pairs of blocks to spanning links (every vector with the smallest member of its part) and link counts.

    A query's links have a null ``home``.  Those of an indexed vector are counted for each
    ``home`` cell of the queries that found it, except this cell, which it visits itself."""

    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            for cell, q_ids, q_vecs, q_n, homes, i_ids, i_vecs, i_n in zip(*(batch.column(c).to_pylist() for c in range(8))):
                q, i, home = np.array(q_ids), np.array(i_ids), np.array(homes, np.int64)
                hit = unit(q_vecs) @ unit(i_vecs).T >= threshold
                hit &= q[:, None] != i[None, :]
                rows, cols = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
                if not len(rows):
                    continue
                hit, q, i, home = hit[np.ix_(rows, cols)], q[rows], i[cols], home[rows]
                q_copies, i_copies = np.array(q_n, np.int64)[rows], np.array(i_n, np.int64)[cols]
                most = np.iinfo(np.int64).max
                lq, li = q.copy(), i.copy()
                while True:
                    nq = np.minimum(lq, np.where(hit, li, most).min(axis=1))
                    ni = np.minimum(li, np.where(hit, nq[:, None], most).min(axis=0))
                    if (nq == lq).all() and (ni == li).all():
                        break
                    lq, li = nq, ni
                own, at = np.unique(home, return_inverse=True)
                counts = np.zeros((len(own), len(i)), np.int64)
                np.add.at(counts, at, hit * q_copies[:, None])
                counts[own == cell] = 0
                h, c = np.nonzero(counts)
                parts = ((q, hit @ i_copies, lq, [None] * len(q)), (i, np.zeros(len(i), np.int64), li, [None] * len(i)),
                         (i[c], counts[h, c], li[c], own[h].tolist()))
                for part in parts:
                    for column, values in zip(out, part):
                        column.extend(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["id", "n", "root", "home"])

    return run


def _blocks(rows: DataFrame, name: str, *more: str) -> DataFrame:
    """(label, cell) groups cut into blocks of about BLOCK vectors; columns ``more`` go along."""
    size = rows.groupBy("label", "cell").agg(F.ceil(F.count("*") / BLOCK).alias("_blocks"))
    return (rows.join(stored(size, f"{name}_sizes"), ["label", "cell"])
            .withColumn("_b", F.pmod(F.xxhash64("id"), F.col("_blocks")))
            .groupBy("label", "cell", "_b")
            .agg(F.collect_list("id").alias(f"{name}_ids"), F.collect_list("vec").alias(f"{name}_vecs"), F.collect_list("copies").alias(f"{name}_n"),
                 *[F.collect_list(m).alias(f"{name}_{m}") for m in more])
            .drop("_b"))


def _packed(batches):
    """Vectors as bytes of doubles; null for those that link with nothing."""
    for batch in batches:
        out = []
        for v in batch.column(2).to_pylist():
            x = np.array(v, np.float64) if v and None not in v else np.zeros(0)
            ok = len(x) and np.isfinite(x).all()
            top = np.abs(x).max() if ok else 0  # scaled first, so that squares neither vanish nor overflow
            out.append((x / top).tobytes() if top > 0 else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["vec_id", "label", "vec"])


def link_vectors(vectors: DataFrame, threshold: float = 0.93, recall: float = 0.99, sample: int = 8192) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = stored(rows.mapInArrow(_packed, "vec_id long, label string, vec binary"), "rows")
    good = rows.filter("label IS NOT NULL AND vec IS NOT NULL")
    classes = stored(good.distinct().groupBy("label", "vec").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
                     .select(F.coalesce("least", F.xxhash64("label", "vec")).alias("id"), "label", "vec", "copies", "least"), "classes")
    n = classes.count()
    own = classes.select("label", "vec", "id", "copies")
    if n:
        picked = bounded_sample(classes.select("id"), F.col("id"), sample).join(classes, "id").select("id", "vec").toArrow().to_pylist()
        lengths = [len(r["vec"]) for r in picked]
        usual = max(set(lengths), key=lambda w: (lengths.count(w), w))
        x = unit([r["vec"] for r in sorted(picked, key=lambda r: r["id"]) if len(r["vec"]) == usual])
        x = x[np.random.default_rng(55).permutation(len(x))]
        k = 1 << int(np.clip(np.ceil(np.log2(np.sqrt(n / 256))), 1, 10))
        grid = spark.sparkContext.broadcast(Grid(x, k, threshold, recall))
        placed = stored(classes.select("id", "label", "vec", "copies").mapInArrow(_placed(grid), "id long, label string, vec binary, copies long, cell long, visits array<long>"), "placed")
        index = _blocks(placed.drop("visits"), "i")
        visits = placed.withColumn("home", F.col("cell")).withColumn("cell", F.explode("visits")).drop("visits")
        queries = _blocks(visits, "q", "home")
        met = queries.join(stored(index, "index"), ["label", "cell"]).select("cell", "q_ids", "q_vecs", "q_n", "q_home", "i_ids", "i_vecs", "i_n")
        found = stored(met.mapInArrow(_met(threshold), "id long, n long, root long, home long"), "found")
        # a vector that was found, and does not visit the finder's home, never finds it: the link is counted here
        one_sided = (found.filter("home IS NOT NULL").groupBy("id", "home").agg(F.sum("n").alias("n"))
                     .join(placed.select("id", "visits"), "id").filter(~F.array_contains("visits", F.col("home"))).select("id", "n"))
        counted = found.filter("home IS NULL").select("id", "n").unionByName(one_sided).groupBy("id").agg(F.sum("n").alias("_n"))
        component = connected_components(found.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
        own = (own.join(counted, "id", "left")
               .join(component, "id", "left"))
    else:
        own = own.withColumns({"_n": F.lit(None).cast("long"), "component": F.lit(None).cast("long")})
    own = own.select("label", "vec", (F.col("copies") - 1 + F.coalesce("_n", F.lit(0))).alias("_links"), F.coalesce("component", "id").alias("_c"))
    out = rows.join(own, ["label", "vec"], "left")
    component_id = F.coalesce("_c", "vec_id")
    return out.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component_id).alias("kept"))
