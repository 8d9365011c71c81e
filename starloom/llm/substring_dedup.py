"""Suffix-array dedup: remove every byte covered by a string of ``length`` bytes that also starts elsewhere.

A suffix array over the corpus finds those strings: a suffix whose common
prefix with a neighbour has ``length`` bytes or more starts one.  Only
suffixes whose order can matter are sorted, and they are dealt to shards
so that equal strings meet:

1. Anchors.  Of the K-byte pieces of a string of ``length`` bytes the one with
   the least hash (the leftmost of equals) is its anchor.  Equal strings have
   equal anchors at equal offsets, so a string can repeat only if its anchor's
   hash does.  Every anchor stands for a run of starting places; its *context*
   is the bytes that the strings at those places span.
2. Equal contexts collapse to one row with a count, however many copies hold
   them.  Anchors found once, or whose contexts are all equal, need no sorting.
3. All contexts of the remaining anchors are dealt by anchor to shards, and each
   shard's suffixes are sorted by external induced sorting (see ``induced_sort``;
   queues spill to disk).  A start whose common prefix with the suffix before or
   after it reaches ``length`` is repeated.  Contexts with a count of two or more
   are repeated throughout and take part as partners.  An anchor with more than
   ``hot`` different contexts is split: strings whose anchor stands 2**j to
   2**(j+1)-1 bytes in share at least 2**j bytes before it, so they are dealt
   by those bytes too.  Such a key can still hold any number of contexts (own
   texts around one passage); where it holds more than ``key_bytes``, its starts
   are not sorted but counted, by key and a hash of their ``length`` bytes, with
   partial aggregation.  So no task holds more than its shard and one such key.
4. Repeated starts return to their documents as byte ranges, which are joined
   and cut out.

Defined results
* null text is empty: nothing to remove, the hash of no bytes.
* texts shorter than ``length`` lose nothing; matches never cross documents.
* repeated rows are further copies, so all of them lose their repeated bytes.
* a null doc_id is an id like any other; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import batch_bytes, mix, powers, prefix_hash, span_hash, stored
from starloom.llm.induced_sort import visit_suffixes

K = 96
FIELDS = "ah long, ch long, _d long, _t long, first int, owned int"


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while 2 * have <= width:
        out, have = np.minimum(out[:-have], out[have:]), 2 * have
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have:])
    return out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, k: int = K, with_context: bool = True):
    """(text, first start, number of starts, anchor's place, anchor hash, context hash) of every anchor;
    places count from the beginning of ``data``."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    prefix = prefix_hash(data)
    _, inv = powers(n + 1)
    piece = (prefix[k:] - prefix[:-k]) * inv[: n - k + 1]
    piece *= np.uint64(0xBF58476D1CE4E5B9)
    bits = max(1, int(n - 1).bit_length())
    tagged = (piece >> np.uint64(bits) << np.uint64(bits)) | np.arange(len(piece), dtype=np.uint64)
    least = _window_min(tagged, length - k + 1)
    at = (least & np.uint64((1 << bits) - 1)).astype(np.int64)  # the anchor's place for a string at each start
    text = np.searchsorted(offsets, np.arange(len(at)), "right") - 1
    whole = np.arange(len(at)) + length <= offsets[text + 1]
    starts = np.flatnonzero(whole)
    at, text = at[starts], text[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    owned = np.diff(np.append(head, len(starts)))
    first, place = starts[head], at[head]
    ah = mix(piece[place])
    ch = span_hash(prefix, first, first + owned - 1 + length) if with_context else ah
    return text[head], first, owned, place, ah, ch


def _anchor_hashes(length):
    def run(batches):
        for batch in batches:
            for _, data, offsets in batch_bytes(batch.column(0)):
                hashes, counts = np.unique(anchors(data, offsets, length, with_context=False)[4].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(counts)], names=["ah", "n"])

    return run


def _anchor_rows(length):
    def run(batches):
        for batch in batches:
            d, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for row, data, offsets in batch_bytes(batch.column(2)):
                text, first, owned, _, ah, ch = anchors(data, offsets, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ah.view(np.int64)), pa.array(ch.view(np.int64)), pa.array(d[row + text]), pa.array(t[row + text]),
                     pa.array((first - offsets[text]).astype(np.int32)), pa.array(owned.astype(np.int32))],
                    names=["ah", "ch", "_d", "_t", "first", "owned"])

    return run


def _parts(batch, length: int, k: int):
    """(key, n, _d, _t, first, owned, bytes, hot) of a batch (text, its list of contexts); hot ones are cut by the anchor's distance."""
    d, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    lists = batch.column(3)
    at = lists.offsets.to_numpy()
    ah, n, first, owned, hot = (lists.values.field(i).to_numpy(zero_copy_only=False) for i in range(5))
    for row, data, offsets in batch_bytes(batch.column(2)):
        raw = data.tobytes()
        for i in range(len(offsets) - 1):
            base = offsets[i]
            for j in range(at[row + i] - at[0], at[row + i + 1] - at[0]):
                lo = int(base + first[j])
                parts = [(int(ah[j]), 0, int(owned[j]))]
                if hot[j]:
                    place = int(anchors(data[lo:lo + int(owned[j]) - 1 + length], np.array([0, int(owned[j]) - 1 + length]), length, k, False)[3][0])
                    parts = _by_distance(raw, lo, place, int(owned[j]), int(ah[j]), length, k)
                for key, a, b in parts:
                    yield key, int(n[j]), int(d[row + i]), int(t[row + i]), int(first[j]) + a, b - a, raw[lo + a:lo + b - 1 + length], bool(hot[j])


def _contexts(length, k, large):
    """Rows (text, its list of contexts) to the contexts' bytes, without the keys that are too large to sort."""

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            held = 0
            for *part, hot in _parts(batch, length, k):
                if hot and part[0] in large.value:
                    continue
                for col, v in zip(out, part):
                    col.append(v)
                held += len(part[6])
                if held > 4 << 20:
                    yield _rows(out)
                    out, held = [[] for _ in range(7)], 0
            yield _rows(out)

    return run


def _key_bytes(length, k):
    """(key, bytes) of the hot contexts of a task."""

    def run(batches):
        for batch in batches:
            held: dict[int, int] = {}
            for key, *_, body, _ in _parts(batch, length, k):
                held[key] = held.get(key, 0) + len(body)
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.int64()), pa.array(held.values(), pa.int64())], names=["key", "bytes"])

    return run


def _start_rows(out):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], names=["key", "h", "_d", "_t", "lo", "n"])


def _start_hashes(length, k, large):
    """(key, h, _d, _t, lo, n) of every start whose key is too large to sort."""

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for key, n, d, t, first, owned, body, hot in _parts(batch, length, k):
                if not hot or key not in large.value:
                    continue
                at = np.arange(owned)
                h = span_hash(prefix_hash(np.frombuffer(body, np.uint8)), at, at + length).view(np.int64)
                for col, v in zip(out, (np.full(owned, key), h, np.full(owned, d), np.full(owned, t), first + at, np.full(owned, n))):
                    col.append(v)
                if len(out[0]) == 4096:
                    yield _start_rows(out)
                    out = [[] for _ in range(6)]
            if out[0]:
                yield _start_rows(out)

    return run


def _rows(out):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["key", "n", "_d", "_t", "first", "owned", "body"])


def _by_distance(raw: bytes, lo: int, place: int, owned: int, ah: int, length: int, k: int):
    """Parts (key, from, to) of a context's starts; the anchor stands at lo + place.  A start
    at distance 2**j to 2**(j+1)-1 before the anchor has 2**j known bytes before it."""
    far = place  # distance of the first start
    near = place - owned + 1
    top = far
    while top >= near:
        j = top.bit_length() - 1 if top > 0 else -1
        low = max(near, 1 << j if j >= 0 else 0)
        most = min(max(0, (2 << j) - 1 if j >= 0 else 0), length - k)  # the class's farthest start, whether this context has it or not
        shared = raw[lo + place - (1 << j if j >= 0 else 0):lo + place]
        after = raw[lo + place + k:lo + place + length - most]
        tag = hashlib.blake2b(ah.to_bytes(8, "little", signed=True) + bytes([j + 1]) + shared + after, digest_size=8).digest()
        yield int.from_bytes(tag, "little", signed=True), place - top, place - low + 1
        top = low - 1


def _sort_shard(length, budget, in_memory):
    """All contexts of a shard to the byte ranges of their repeated starts."""

    def run(batches):
        bodies, rows = [], []
        for batch in batches:
            for i, data, offsets in batch_bytes(batch.column(6), 1 << 30):
                n = len(offsets) - 1
                out = np.zeros(len(data) + n, np.uint8)
                out[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
                bodies.append(out)
                rows.append(np.stack([batch.column(c).slice(i, n).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(1, 6)]
                                     + [np.diff(offsets)]))
        if not rows:
            return
        raw = np.concatenate(bodies)
        del bodies
        n, d, t, first, owned, size = np.concatenate(rows, axis=1)
        begins = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
        # zero bytes of a text would read as separators: they change places with a byte value that UTF-8 never has
        text = raw
        ends = begins + size
        zero = np.flatnonzero(raw == 0)
        if len(zero) > len(ends):
            inner = np.setdiff1d(zero, ends, assume_unique=True)
            text[inner] = 0xFF
        repeated = np.zeros(len(text), bool)
        last = [None]

        def visit(pos, lcp):
            hit = lcp >= length
            repeated[pos[hit]] = True
            before = np.append(last[0] if last[0] is not None else pos[0], pos[:-1])
            repeated[before[hit]] = True
            last[0] = pos[-1]

        visit_suffixes(text, visit, length, budget, in_memory)
        at = np.flatnonzero(repeated)
        row = np.searchsorted(begins, at, "right") - 1
        inside = (at - begins[row] < owned[row]) & (n[row] < 2)
        at, row = at[inside], row[inside]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(at)) - 1
        r = row[heads]
        yield pa.RecordBatch.from_arrays(
            [pa.array(d[r]), pa.array(t[r]), pa.array((first[r] + at[heads] - begins[r]).astype(np.int32)),
             pa.array((first[r] + at[tails] - begins[r] + length).astype(np.int32))], names=["_d", "_t", "lo", "hi"])

    return run


def _cut(batches):
    for batch in batches:
        ids, texts, spans = batch.column(0), batch.column(1), batch.column(2)
        size, gone, runs, sha = [], [], [], []
        for i in range(len(ids)):
            raw = (texts[i].as_py() or "").encode()
            kept, at, n_runs = hashlib.sha256(), 0, 0
            removed, edge = 0, -1
            for lo, hi in sorted((s["lo"], s["hi"]) for s in (spans[i].as_py() or ())):
                if lo > edge:  # a new run; ranges that touch are one
                    kept.update(raw[at:lo])
                    n_runs += 1
                    removed += hi - lo
                    edge = at = hi
                elif hi > edge:
                    removed += hi - edge
                    edge = at = hi
            kept.update(raw[at:])
            size.append(len(raw))
            gone.append(removed)
            runs.append(n_runs)
            sha.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays([ids, pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha)],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def candidates(texts: DataFrame, length: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """Ranges (_d, _t, lo, hi) of contexts with copies, and (_d, _t, c) of the contexts whose starts are to be compared."""
    twice = stored(texts.select("text").mapInArrow(_anchor_hashes(length), "ah long, n long")
                   .groupBy("ah").agg(F.sum("n").alias("n")).filter("n > 1").select("ah"), "twice")
    found = stored(texts.select("_d", "_t", "text").mapInArrow(_anchor_rows(length), FIELDS).join(twice, "ah"), "found")
    classes = stored(found.groupBy("ah", "ch").agg(F.count("*").alias("n"), F.min(F.struct("_d", "_t", "first", "owned")).alias("one")), "classes")
    # contexts with copies: repeated throughout
    copies = (found.join(classes.filter("n > 1").select("ah", "ch"), ["ah", "ch"])
              .select("_d", "_t", F.col("first").alias("lo"), (F.col("first") + F.col("owned") - 1 + length).alias("hi")))
    # anchors with several contexts: their suffixes are sorted
    several = classes.groupBy("ah").agg(F.count("*").alias("_k")).filter("_k > 1")
    wanted = stored(classes.join(several, "ah").select(
        "one._d", "one._t", F.struct("ah", "n", "one.first", "one.owned", (F.col("_k") > hot).cast("int").alias("hot")).alias("c")), "wanted")
    return copies, wanted


def too_large(texts: DataFrame, wanted: DataFrame, length: int, key_bytes: int) -> set[int]:
    """The keys of hot anchors whose contexts have more than ``key_bytes`` bytes: one for each ``key_bytes`` of all contexts at most."""
    lists = wanted.filter("c.hot = 1").groupBy("_d", "_t").agg(F.collect_list("c").alias("cs"))
    if lists.isEmpty():
        return set()
    sizes = texts.join(lists, ["_d", "_t"]).select("_d", "_t", "text", "cs").mapInArrow(_key_bytes(length, K), "key long, bytes long")
    return {r[0] for r in sizes.groupBy("key").agg(F.sum("bytes").alias("bytes")).filter(F.col("bytes") > key_bytes).select("key").collect()}


def repeated_ranges(texts: DataFrame, length: int, hot: int = 4096, shard_bytes: int = 6 << 20,
                    budget: int = 64 << 20, in_memory: int = 4 << 20, key_bytes: int = 6 << 20) -> DataFrame:
    """(_d, _t, lo, hi): byte ranges of the rows (_d, _t, text) covered by repeated strings."""
    copies, wanted = candidates(texts, length, hot)
    keys = too_large(texts, wanted, length, key_bytes)
    large = texts.sparkSession.sparkContext.broadcast(keys)
    volume = wanted.agg(F.sum(F.col("c.owned") + length)).first()[0] or 0
    shards = max(1, volume // shard_bytes, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")) if volume > shard_bytes else 1)
    lists = wanted.groupBy("_d", "_t").agg(F.collect_list("c").alias("cs"))
    held = texts.join(lists, ["_d", "_t"]).select("_d", "_t", "text", "cs")
    bodies = (held.mapInArrow(_contexts(length, K, large), "key long, n long, _d long, _t long, first int, owned int, body binary"))
    partly = bodies.repartition(int(shards), "key").mapInArrow(_sort_shard(length, budget, in_memory), "_d long, _t long, lo int, hi int")
    out = copies.unionByName(partly)
    if not keys:
        return out
    starts = stored(held.mapInArrow(_start_hashes(length, K, large), "key long, h long, _d long, _t long, lo long, n long"), "starts")
    again = stored(starts.groupBy("key", "h").agg(F.sum("n").alias("_all")).filter("_all > 1").select("key", "h"), "again")
    return out.unionByName(starts.filter("n < 2").join(again, ["key", "h"])
                           .select("_d", "_t", F.col("lo").cast("int").alias("lo"), (F.col("lo") + length).cast("int").alias("hi")))


def dedup_substrings(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumns(
        {"_d": F.coalesce("doc_id", F.lit(-1)), "_t": F.xxhash64(F.coalesce("text", F.lit("")))})
    spans = (repeated_ranges(texts, length, **options).groupBy("_d", "_t")
             .agg(F.collect_set(F.struct("lo", "hi")).alias("spans")))
    return (texts.join(spans, ["_d", "_t"], "left").select("doc_id", "text", "spans")
            .mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
