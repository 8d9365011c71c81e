"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X (n vectors of width d, in fixed point so that their sums are exact)
are never multiplied with themselves.  Each step is one distributed pass: a task
takes its blocks of rows, makes its part of p = X v - beta u (the left vector of the step
before is X w with a short w, so it is made anew from the rows instead of being
kept, and a lost executor loses nothing) and adds up X'p, p'p and the products of
p with all earlier left vectors.  The driver holds vectors of width d only: it
takes out what p shares with earlier left vectors (another pass follows if that is
more than rounding), makes the next right vector orthogonal to all earlier ones, and
writes both norms into the bidiagonal.  Its SVD gives the components.  When nothing new
is left in the Krylov space, or the wanted components have settled, a random vector
orthogonal to all others goes on from there (``probe`` steps), so a repeated
eigenvalue is not missed.

Defined results
* rows whose vector is null, empty or holds null or non-finite entries are dropped; so are vectors whose
  length is not the most frequent one (the greater one at a tie).
* repeated rows count as often as they occur; null ids stay; other columns are ignored.
* components whose eigenvalue is zero (under 1e-13 of the largest) are not returned: there are at most
  as many as the rows have rank, so equal or empty tables give no rows.
* entries of magnitude beyond 2**40 / 64 count as that; a deviation beyond 63 bits is null.
* the sign of a component is such that its largest entry in magnitude is positive; equal eigenvalues
  come in any basis of their space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import stored

SCALE, OFFSET, LIMIT = 64, 1_000_000, 1 << 40
BLOCK = 2048  # rows of a block


def _blocks(width: int):
    """Rows (id, vector) to blocks (ids, fixed-point rows as bytes)."""

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, BLOCK):
                part = batch.slice(s, BLOCK)
                vectors = part.column(1)
                c = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                x = np.clip(np.floor(SCALE * c), -LIMIT, LIMIT).astype(np.int64) + OFFSET
                ids = part.column(0)
                ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                                                  pa.array([x.tobytes()], pa.binary())], names=["ids", "x"])

    return run


def _sums(width: int):
    """(dimension, sum) of a task's rows, and their number as dimension -1."""

    def run(batches):
        total, n = [0] * width, 0
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                x = np.frombuffer(raw, np.int64).reshape(-1, width)
                total = [a + int(b) for a, b in zip(total, x.sum(axis=0))]
                n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(width)]), pa.array([n, *total])], names=["i", "s"])

    return run


class Centre:
    """The exact mean S / n, as whole part and remainder."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)
        self.width = len(sums)

    def rows(self, raw: bytes) -> np.ndarray:
        """x - S / n in double precision."""
        return (np.frombuffer(raw, np.int64).reshape(-1, self.width) - self.whole) - self.rest / self.n

    def deviations(self, raw: bytes) -> list[int | None]:
        """Sums over dimensions of (n * x - S)**2, exact."""
        x = np.frombuffer(raw, np.int64).reshape(-1, self.width) - self.whole
        bound = (self.n * (int(np.abs(x).max(initial=0)) + 1)) ** 2 * self.width
        if bound < 2 ** 63:
            return ((self.n * x - self.rest) ** 2).sum(axis=1).tolist()
        sums = ((self.n * x.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return [int(s) if s < 2 ** 63 else None for s in sums]


def _added(blocks: DataFrame, work, size: int) -> np.ndarray:
    """The sum over all blocks of work(raw block), vectors of ``size`` entries, added up in tasks first."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total += work(raw)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["i", "s"])

    out = np.zeros(size)
    for i, s in blocks.select("x").mapInArrow(run, "i long, s double").groupBy("i").agg(F.sum("s")).collect():
        out[i] = s
    return out


class Bidiagonal:
    """Right vectors V, short forms W of the left vectors X W, their products Z = X'X W, and the two diagonals."""

    def __init__(self, blocks: DataFrame, centre: Centre, seed: int = 13):
        self.blocks, self.centre, self.width = blocks, centre, centre.width
        self.v, self.w, self.z = (np.zeros((self.width, 0)) for _ in range(3))
        self.alpha: list[float] = []
        self.beta: list[float] = []  # beta[j] stands above alpha[j + 1]
        self.rng = np.random.default_rng(seed)
        self.trace = 0.0
        self.next = self.fresh()

    def fresh(self) -> np.ndarray | None:
        """A random unit vector orthogonal to all right vectors; None if they fill the space."""
        if self.v.shape[1] == self.width:
            return None
        r = self.rng.standard_normal(self.width)
        for _ in range(3):
            r -= self.v @ (self.v.T @ r)
            r /= np.linalg.norm(r)
        return r

    def products(self, w: np.ndarray):
        """X'p, U'p and p'p for p = X w and all left vectors U = X W; and the sum of squares of X."""
        earlier, centre = self.w, self.centre
        d, k = self.width, earlier.shape[1]

        def work(raw):
            x = centre.rows(raw)
            p = x @ w
            return np.concatenate((x.T @ p, (x @ earlier).T @ p, [p @ p, (x * x).sum()]))

        out = _added(self.blocks, work, d + k + 2)
        return out[:d], out[d:d + k], out[d + k], out[d + k + 1]

    def step(self) -> None:
        """One more right and left vector."""
        v = self.next
        w = v - self.beta[-1] * self.w[:, -1] if self.beta else v.copy()
        for _ in range(3):
            back, shared, square, total = self.products(w)
            self.trace = total
            rest = square - shared @ shared
            w = w - self.w @ shared
            back = back - self.z @ shared
            if shared @ shared <= 1e-16 * square:
                break  # nothing but rounding was shared with earlier left vectors
        largest = max(self.alpha, default=0.0)
        a = float(np.sqrt(max(rest, 0.0)))
        if a <= 1e-13 * max(largest, np.sqrt(self.trace)):
            a, w, back = 0.0, np.zeros_like(w), np.zeros_like(back)
        else:
            w, back = w / a, back / a
        self.alpha.append(a)
        self.v = np.column_stack((self.v, v))
        self.w = np.column_stack((self.w, w))
        self.z = np.column_stack((self.z, back))
        r = back - a * v
        for _ in range(2):
            r = r - self.v @ (self.v.T @ r)
        b = float(np.linalg.norm(r))
        if b <= 1e-13 * np.sqrt(self.trace) or self.v.shape[1] == self.width:
            self.next, b = self.fresh(), 0.0
        else:
            self.next = r / b
        self.beta.append(b)

    def restart(self) -> None:
        self.next = self.fresh()
        self.beta[-1] = 0.0

    def svd(self):
        j = len(self.alpha)
        b = np.diag(self.alpha)
        b[np.arange(j - 1), np.arange(1, j)] = self.beta[:-1]
        return np.linalg.svd(b)

    def settled(self, k: int) -> bool:
        """Whether the k leading singular vectors leave no residual beyond rounding."""
        if len(self.alpha) < min(k, self.width):
            return False
        left, s, _ = self.svd()
        return bool(np.all(np.abs(self.beta[-1] * left[-1, :k]) <= 1e-14 * s[0]))


def principal(blocks: DataFrame, centre: Centre, k: int, probe: int = 16) -> tuple[np.ndarray, np.ndarray, float]:
    """The k leading components (columns), their eigenvalues, and the trace of the covariance."""
    work = Bidiagonal(blocks, centre)
    until = None
    while work.next is not None:
        work.step()
        if work.trace == 0:
            return np.zeros((centre.width, 0)), np.zeros(0), 0.0
        if until is None and work.next is not None and work.settled(k):
            work.restart()
            until = len(work.alpha) + probe
        elif until is not None and len(work.alpha) >= until and work.settled(k):
            break
    _, s, right = work.svd()
    keep = np.flatnonzero(s[:k] ** 2 > 1e-13 * s[0] ** 2)
    vectors = work.v @ right[keep].T
    top = np.abs(vectors).argmax(axis=0)
    vectors *= np.sign(vectors[top, np.arange(len(keep))])
    return vectors, s[keep] ** 2 / centre.n, work.trace / centre.n


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every vector kept and each
    component up to ``components``."""
    id_type = embeddings.schema[id_col].dataType
    good = embeddings.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x")).filter(F.expr("x IS NOT NULL AND size(x) > 0"))
    good = good.filter(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    schema = T.StructType([T.StructField("vec_id", id_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    spark = embeddings.sparkSession
    common = good.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    width = common["w"]
    block_type = T.StructType([T.StructField("ids", T.ArrayType(id_type)), T.StructField("x", T.BinaryType())])
    blocks = stored(good.filter(F.size("x") == width).mapInArrow(_blocks(width), block_type), "blocks")
    sums = {r[0]: int(r[1]) for r in blocks.select("x").mapInArrow(_sums(width), "i long, s long")
            .groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)"))).collect()}
    n = sums.pop(-1)
    centre = Centre(n, [sums[i] for i in range(width)])
    vectors, values, trace = principal(blocks, centre, components)
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    project = vectors / np.sqrt(values)

    def moments(raw):
        y = centre.rows(raw) @ project
        return np.concatenate((y.sum(axis=0), (y.T @ y).ravel()))

    got = _added(blocks, moments, k + k * k)
    mean = got[:k] / n
    error = float(np.abs(got[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())
    explained = values / trace

    def rows(batches):
        for batch in batches:
            for ids, raw in zip(batch.column(0), batch.column(1).to_pylist()):
                ids, y, dev = ids.values, centre.rows(raw) @ project, centre.deviations(raw)
                m = len(ids)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                    pa.array(dev, pa.int64()).take(each), pa.array(y.ravel()), pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error))], names=schema.names)

    return blocks.mapInArrow(rows, schema)
