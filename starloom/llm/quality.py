"""Quality classifier: nearest-neighbour voting among latent-semantic vectors.

A text's terms are its lower-cased words (hashed to ``WORDS`` terms) and, beside them, all
trigrams of character classes (which mean the same in every language) and bins of how
its words repeat and how long they and it are.  Weighted by document frequencies over
all labelled training texts, the counts of a bounded sample of them are decomposed
(SVD), and every text is projected to the leading directions.  The labelled vectors,
at most ``bound`` of each label, are broadcast; for every text the cosine with
each of them is computed exactly, block by block, and its nearest ``neighbours``
vote with their labels, weighted by similarity.

Defined results
* null or empty text has no words, no trigrams and the bins of an empty text; it is scored like any other.
* labels come from rows whose id's crc32 modulo 3 is not 1; rows with null doc_id
  or null label are never learned from; a repeated label row counts once (the largest label).
* without any labelled row the score is 0.5; ties at 0.5 are predicted 1.
* repeated rows get equal scores; other columns are never inputs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import batch_bytes, bitmap_place, bounded_sample, id_bitmap, id_remainder, in_bitmap, lowered, prefix_hash, span_hash, word_spans

CLASSES = 16
_CLASS = np.full(256, 15, np.uint8)
for _i, _chars in enumerate((b" ", b"\n", b"\t\r\x0b\x0c", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                             bytes(range(128, 256)), b".", b",", b"!?", b"|", b"*#%&$~^=+_", b"-", b"()[]{}<>\"'`", b"@:;/\\")):
    _CLASS[list(_chars)] = _i
TRIGRAMS = CLASSES ** 3
BINS = 12
WORD_BITS = 12
WORDS = 1 << WORD_BITS
SHAPE = TRIGRAMS + 4 * BINS
DIMS = SHAPE + WORDS


def term_weights(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of weights for each text: root frequencies of class trigrams, four groups of bins, and root frequencies of words."""
    n = len(offsets) - 1
    out = np.zeros((n, DIMS), np.float32)
    c = _CLASS[data].astype(np.int64)
    if len(c) > 2:
        owner = np.repeat(np.arange(n), np.diff(offsets))
        same = owner[2:] == owner[:-2]
        code = (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:]
        counts = np.bincount(owner[:-2][same] * TRIGRAMS + code[same], minlength=n * TRIGRAMS).reshape(n, TRIGRAMS)
        out[:, :TRIGRAMS] = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))
    low = lowered(data)
    starts, ends, first = word_spans(low, offsets)
    words = span_hash(prefix_hash(low), starts, ends)
    total = np.diff(first)
    owner = np.repeat(np.arange(n), total)
    repeats = np.bincount(owner[1:][(words[1:] == words[:-1]) & (owner[1:] == owner[:-1])], minlength=n)
    order = np.lexsort((words, owner))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order][new], minlength=n)
    length = np.bincount(owner, ends - starts, n)
    some = np.maximum(total, 1)
    groups = (np.minimum(BINS - 1, np.sqrt(repeats / some) * BINS), np.minimum(BINS - 1, distinct / some * BINS),
              np.minimum(BINS - 1, length / some), np.minimum(BINS - 1, np.log2(np.diff(offsets) + 1) / 2))
    for g, v in enumerate(groups):
        out[np.arange(n), TRIGRAMS + g * BINS + v.astype(np.int64)] = 0.25
    term = (words >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    counts = np.bincount(owner * WORDS + term, minlength=n * WORDS).reshape(n, WORDS)
    out[:, SHAPE:] = np.sqrt(counts / some[:, None])
    return out


def _weighted(column):
    """(first row, term weights) of runs of 128 texts at most, so that short texts do not make a huge matrix."""
    for row, data, offsets in batch_bytes(column, 1 << 20):
        for a in range(0, len(offsets) - 1, 128):
            part = offsets[a:a + 129]
            yield row + a, term_weights(data[part[0]:part[-1]], part - part[0])


def _packed(x: np.ndarray) -> bytes:
    at = np.flatnonzero(x)
    return at.astype(np.uint16).tobytes() + x[at].astype(np.float16).tobytes()


def _unpack(raw: bytes, out: np.ndarray) -> None:
    half = len(raw) // 2
    out[np.frombuffer(raw[:half], np.uint16)] = np.frombuffer(raw[half:], np.float16)


def _wanted(bitmap):
    """Rows (id, text, bitmap place) whose id may be wanted."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(bitmap.value, batch.column(2).to_numpy()))).select([0, 1])

    return run


def _weights(batches):
    for batch in batches:
        for row, x in _weighted(batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(x)), pa.array([_packed(v) for v in x], pa.binary())], names=["doc_id", "x"])


def _frequencies(batches):
    """(term, texts that hold it) of a task, and the number of its texts as term -1."""
    held, n = np.zeros(DIMS, np.int64), 0
    for batch in batches:
        for _, x in _weighted(batch.column(0)):
            held += (x > 0).sum(axis=0)
            n += len(x)
    at = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(held[at], n))], names=["term", "n"])


def leading_directions(x: np.ndarray, k: int, rounds: int = 4, spare: int = 16) -> np.ndarray:
    """The k leading right singular vectors of x, by subspace iteration from a fixed start."""
    k = min(k, *x.shape)
    q = np.random.default_rng(6).standard_normal((x.shape[1], min(k + spare, *x.shape))).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ v.T)[:, :k]


class Voter:
    """Directions, and the labelled vectors along them."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, held: np.ndarray, total: int, directions: int = 64, neighbours: int = 15):
        """``held`` of ``total`` texts hold each term; the sample's weights ``x`` are used up."""
        self.k, self.labels = min(neighbours, len(labels)), labels.astype(np.float32)
        weight = np.log((total + 1) / (held + 1)).astype(np.float32) + 1
        x *= weight
        # shape and words weigh the same over the sample
        even = np.float32(np.linalg.norm(x[:, :SHAPE]) / max(np.linalg.norm(x[:, SHAPE:]), 1e-12))
        x[:, SHAPE:] *= even
        weight[SHAPE:] *= even
        own = leading_directions(x, directions).astype(np.float32)
        self.base = own
        self.vectors = self.project(x)
        self.base = weight[:, None] * own

    def project(self, x: np.ndarray) -> np.ndarray:
        y = x @ self.base
        return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for a in range(0, len(x), 256):
            cos = self.project(x[a:a + 256]) @ self.vectors.T
            near = np.argpartition(-cos, self.k - 1, axis=1)[:, :self.k]
            # similarity weighs by its distance from 1, so close neighbours outvote far ones
            weight = 1 / (1.001 - np.minimum(np.take_along_axis(cos, near, axis=1).astype(np.float64), 1.0))
            out[a:a + 256] = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0, 1)


def _scored(model):
    def run(batches):
        voter: Voter | None = model.value
        for batch in batches:
            if voter is None:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(batch), 0.5))], names=["doc_id", "score"])
                continue
            for row, x in _weighted(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(x)), pa.array(voter.score(x))], names=["doc_id", "score"])

    return run


def learn(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, bound: int = 2500) -> Voter | None:
    """From the document frequencies of all labelled texts, and at most ``bound`` documents of each label, those with the smallest id hash."""
    own = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (id_remainder(F.col("doc_id"), modulus) != held))
           .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    chosen = {r["doc_id"]: int(r["quality"] > 0) for r in bounded_sample(own, F.col("doc_id"), bound, within=F.col("quality")).collect()}
    if not chosen:
        return None
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.filter(F.col("doc_id").isin(list(chosen))).mapInArrow(_weights, "doc_id long, x binary").dropDuplicates(["doc_id"]).toArrow()
    if not len(rows):
        return None
    train = own.select(F.col("doc_id").cast("long").alias("doc_id"))
    bitmap = docs.sparkSession.sparkContext.broadcast(id_bitmap(train, "doc_id"))
    near = texts.filter("doc_id IS NOT NULL").withColumn("_h", bitmap_place(F.col("doc_id"))).mapInArrow(_wanted(bitmap), "doc_id long, text string")
    counts = (near.join(train, "doc_id", "left_semi").select("text")
              .mapInArrow(_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow())  # one row for each term
    held = np.zeros(DIMS + 1, np.int64)
    held[counts.column("term").to_numpy()] = counts.column("n").to_numpy()  # term -1 is the last place
    ids = rows.column("doc_id").to_numpy()
    x = np.zeros((len(ids), DIMS), np.float32)
    for i, at in enumerate(np.argsort(ids).tolist()):
        _unpack(rows.column("x")[at].as_py(), x[i])
    return Voter(x, np.array([chosen[i] for i in np.sort(ids).tolist()]), held[:-1], int(held[-1]))


def score_quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, modulus, held, **options))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_scored(model), "doc_id long, score double")
    return out.select("doc_id", F.coalesce(id_remainder(F.col("doc_id"), modulus) == held, F.lit(False)).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
