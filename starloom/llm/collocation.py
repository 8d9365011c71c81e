"""Phrase collocation mining by direct-address tiling.

Words of a language are ranked by frequency, and texts become sequences of
ranks.  Neighbouring ids are counted in tasks: the square of head ids is split into
tiles of ``TILE`` x ``TILE`` cells; a tile that many pairs of a run fall into is counted
densely (numpy bincount, the cell is the address), the pairs of sparse tiles and
of ids beyond the head are sorted and counted as coordinates.  Only distinct
pairs of a run leave a task: those of head ids as numbers in a scrambled order, dealt to
groups by range, each as its distance from the one before and packed, so a pair takes two
or three bytes of the shuffle.  Each group's counts are added up in one task,
and only frequent pairs are written.

Frequent pairs are ranked anew and are the ids of the next level: a phrase of k words is
the pair of its first k - 1 words (one id) and its last, so each level counts pairs again,
up to ``longest`` words.  A phrase can only be frequent if all words, its first k - 1 and
its last k - 1 words are, so everything else is left out.

Ids.  The ``head`` most frequent words (``WIDER`` times as many phrases of a level) get their
ranks; that table is broadcast, its size is bounded by ``head``.  Other words get a 62-bit hash of
what they are made of, behind a bitmap of bounded size with the frequent ones; a wrong
hit in the bitmap is counted like any other and fails the minimum count.  Other pairs of ranks
are numbered by their cell, all others hashed likewise.  That two
different phrases share such a hash is looked for in the full counts of each level; if one
is frequent, the level is counted anew with another seed, so counts are exact.

Defined results
* null text counts as empty; null language as ``und``, together with documents that name it.
* texts are cut into words byte by byte (all separators are ASCII), whole texts of any length.
* repeated rows and null ids count as often as they occur; ids and other columns are not read.
* ties of the lowest cut go to the shortest first part, ties of the ranking are listed in ``mine``.
* an empty table, or one without a frequent phrase, gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import UPPER, mix, stored

BREAKS = b".,;:!?\n\x0b\x0c\r"
_TOKEN = re.compile(rb"[^ \t.,;:!?\n\x0b\x0c\r]+|[.,;:!?\n\x0b\x0c\r]")
_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
TILE = 1024
TEXT_RUN = 1 << 21  # bytes of texts that are cut into words at once
RUN = 1 << 20  # pairs that a task counts at once
DISTINCT = 200_000  # words that a task's counter holds
REMEMBERED = 40_000  # words of a language whose hash a task remembers
SEQUENCE_RUN = 1 << 21  # bytes of sequences that are worked off at once
LONG_WORD = 200  # bytes; longer words get a hash whatever their rank
SHARES = 64  # of a language's phrases, ranked apart before all
BITS = 27
WIDER = 4
GROUP = 1 << 21  # word occurrences for each group of pairs, at most
HASHED = np.int64(1 << 62)
FAR = np.int64(1 << 61)  # marks hashes of pairs that have no cell
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _texts(batch: pa.RecordBatch):
    """(language, lower-cased bytes of whole texts) of runs of a batch (lang, text)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    start, done = 0, 0
    while start < len(size):
        stop = max(start + 1, int(np.searchsorted(size, done + TEXT_RUN, "right")))
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(*(batch.column(i).slice(start, stop - start).to_pylist() for i in (0, 1))):
            if text:
                by_lang.setdefault(lang, []).append(text.encode().translate(_LOWER))
        for lang, texts in by_lang.items():
            yield lang, texts
        start, done = stop, int(size[stop - 1])


def _count_words(batches):
    """(language, word, occurrences) of a task."""
    held: dict[str, Counter] = {}

    def flush():
        for lang, c in held.items():
            for k in BREAKS:
                c.pop(bytes([k]), None)
            if c:
                words = list(c)
                for s in range(0, len(words), 100_000):
                    part = words[s:s + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array([w.decode() for w in part], pa.string()),
                                                      pa.array([c[w] for w in part], pa.int64())], names=["lang", "word", "c"])
        held.clear()

    for batch in batches:
        for lang, texts in _texts(batch):
            words = held.setdefault(lang, Counter())
            for data in texts:
                words.update(_TOKEN.findall(data))
            if sum(map(len, held.values())) > DISTINCT:
                yield from flush()
    yield from flush()


def word_hash(lang: str, word: bytes, seed: int) -> int:
    """A 62-bit hash of a word of a language, marked as a hash."""
    key = hashlib.blake2b(word, digest_size=8, key=f"{seed}:{lang}".encode()[:64]).digest()
    return int(HASHED) | int.from_bytes(key, "little") >> 2


def pair_hash(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """62-bit hashes of pairs of ids, marked as hashes."""
    h = mix(a.astype(np.uint64) * _A + np.uint64(seed)) * _B + b.astype(np.uint64)
    return (mix(h) >> np.uint64(2)).astype(np.int64) | HASHED


class Cells:
    """The square of ranks as numbers of ``bits`` bits in a scrambled order, there and back."""

    def __init__(self, head: int):
        self.head, self.wide = head, head * WIDER
        self.bits = max(2, (self.wide * head - 1).bit_length())
        self.mask, self.half = np.uint64((1 << self.bits) - 1), np.uint64((self.bits + 1) // 2)
        self.back = np.uint64(pow(int(_A), -1, 1 << self.bits))

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a < self.wide) & (b < self.head)

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = ((a * self.head + b).astype(np.uint64) * _A) & self.mask
        return (((x ^ (x >> self.half)) * _A) & self.mask).astype(np.int64)

    def pair(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = (number.astype(np.uint64) * self.back) & self.mask
        x = (((x ^ (x >> self.half)) * self.back) & self.mask).astype(np.int64)
        return x // self.head, x % self.head

    def ids(self, a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
        """Ids of pairs without a rank: the marked number of a cell, else a hash."""
        near = self.near(a, b)
        out = np.empty(len(a), np.int64)
        out[near] = self.number(a[near], b[near]) | HASHED
        out[~near] = pair_hash(a[~near], b[~near], seed) | FAR
        return out


class Words(dict):
    """Word -> id for one language: rank, hash, or -1 for breaks and words that are not frequent."""

    def __init__(self, lang: str, ranks: dict[bytes, int], bitmap, seed: int):
        super().__init__(ranks)
        self.update((bytes([b]), -1) for b in BREAKS)
        self.lang, self.bitmap, self.seed, self.room = lang, bitmap, seed, len(self) + REMEMBERED

    def __missing__(self, word: bytes) -> int:
        if self.bitmap is None:
            return -1
        i = word_hash(self.lang, word, self.seed)
        at = i & (1 << BITS) - 1
        if not self.bitmap[at >> 3] >> (at & 7) & 1:
            i = -1
        if len(self) < self.room:
            self[word] = i
        return i


class Level:
    """Pair -> id of the phrases of one length: the head's pairs of ranks in sorted order with their
    ranks, and a bitmap of the ids of other frequent pairs (None if there are none)."""

    def __init__(self, a: np.ndarray, b: np.ndarray, cells: Cells, bitmap, seed: int):
        key = a * cells.head + b
        order = np.argsort(key)
        self.key, self.rank, self.cells, self.bitmap, self.seed = key[order], order.astype(np.int32), cells, bitmap, seed

    def ids(self, a: np.ndarray, b: np.ndarray, valid: np.ndarray) -> np.ndarray:
        out = np.full(len(a), -1, np.int64)
        near = np.flatnonzero(valid & self.cells.near(a, b))
        key = a[near] * self.cells.head + b[near]
        if len(self.key):
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            out[near] = np.where(self.key[at] == key, self.rank[at], -1)
        if self.bitmap is not None:
            rest = np.flatnonzero(valid & (out < 0))
            h = self.cells.ids(a[rest], b[rest], self.seed)
            place = h & (1 << BITS) - 1
            out[rest] = np.where((self.bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1, h, -1)
        return out


def tile_counts(a: np.ndarray, b: np.ndarray, head: int, wide: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs and their counts: dense tiles by address, the rest as sorted coordinates."""
    near = (a < (head if wide is None else wide)) & (b < head)
    across = -(-head // TILE)
    out = []
    x, y = a[near], b[near]
    tile = (x // TILE) * across + y // TILE
    order = np.argsort(tile, kind="stable")
    x, y, tile = x[order], y[order], tile[order]
    edges = np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1], [True]))) if len(tile) else np.zeros(1, np.int64)
    sparse = np.ones(len(tile), bool)
    for s, e in zip(edges[:-1], edges[1:]):
        if e - s < TILE * TILE // 32:
            continue
        sparse[s:e] = False
        cells = np.bincount((x[s:e] % TILE) * TILE + y[s:e] % TILE, minlength=TILE * TILE)
        at = np.flatnonzero(cells)
        out.append((x[s] // TILE * TILE + at // TILE, y[s] // TILE * TILE + at % TILE, cells[at]))
    cell, n = np.unique(x[sparse] * head + y[sparse], return_counts=True)
    out.append((cell // head, cell % head, n))
    x, y = a[~near], b[~near]
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    if len(x):
        first = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]))))
        out.append((x[first], y[first], np.diff(np.append(first, len(x)))))
    return tuple(np.concatenate(p) if p else np.zeros(0, np.int64) for p in (zip(*out) if out else ((), (), ())))


def _sequences(words):
    """Batches (lang, text) to each text's sequence of word ids, -1 where a phrase cannot go on."""

    def run(batches):
        ranks, bitmap, seed = words.value
        known: dict[str, Words] = {}
        for batch in batches:
            for lang, texts in _texts(batch):
                if lang not in known:
                    known[lang] = Words(lang, ranks.get(lang, {}), bitmap, seed)
                rows = []
                for data in texts:
                    tokens = _TOKEN.findall(data)
                    ids = np.fromiter(map(known[lang].__getitem__, tokens), np.int64, len(tokens))
                    ids = ids[(ids >= 0) | np.concatenate(([True], ids[:-1] >= 0))] if len(ids) else ids  # one -1 parts as well as many
                    if len(ids) > 1:
                        rows.append(ids.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])

    return run


def _joined(column: pa.Array):
    """Sequences of a column as one, -1 between them, in runs of about SEQUENCE_RUN bytes or one longer sequence."""
    held, size, part = [], 0, np.int64(-1).tobytes()
    for i in range(len(column)):
        held.append(column[i].as_py())
        size += len(held[-1])
        if size >= SEQUENCE_RUN or i + 1 == len(column):
            yield np.frombuffer(part.join(held), np.int64)
            held, size = [], 0


def _planes(x: np.ndarray) -> tuple[int, bytes]:
    """Non-negative numbers as (bytes each, all first bytes, all second bytes, ...)."""
    width = max(1, -(-int(x.max()).bit_length() // 8))
    return width, x.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unplanes(data: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(width, n).T
    return out.view("<i8").ravel()


def packed(columns: list[np.ndarray]) -> tuple[list[int], bytes]:
    """Columns of equal length: each one's bytes a value, and all as compressed bytes."""
    widths, planes = zip(*map(_planes, columns))
    return list(widths), pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, widths: list[int]) -> list[np.ndarray]:
    raw = pa.decompress(data, n * sum(widths), codec="zstd", asbytes=True)
    ends = np.cumsum(widths) * n
    return [_unplanes(raw[e - w * n:e], n, w) for e, w in zip(ends.tolist(), widths)]


PACKED = "part int, far boolean, n int, widths array<int>, data binary"


def _count_pairs(levels, cells: Cells, groups: int, seed: int):
    """Sequences to counted pairs (phrase of the last level, next word), packed for each of 2**groups groups."""

    def run(batches):
        tables = [level.value for level in levels]
        held, size = [], 0

        def flush():
            a, b, c = tile_counts(*(np.concatenate(x) for x in zip(*held)), cells.head, cells.wide)
            near = cells.near(a, b)
            number, count = cells.number(a[near], b[near]), c[near]
            order = np.argsort(number)
            number, count = number[order], count[order]
            far = [x[~near] for x in (a, b, c)]
            far_part = (pair_hash(far[0], far[1], seed) >> (61 - groups)) & (1 << groups) - 1  # the hash without its mark FAR
            order = np.argsort(far_part, kind="stable")
            far, far_part = [x[order] for x in far], far_part[order]
            rows = []
            for is_far, part, columns in ((False, number >> max(0, cells.bits - groups), [number, count]), (True, far_part, far)):
                edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part)).tolist()
                for s, e in zip(edges[:-1], edges[1:]):
                    own = [x[s:e] for x in columns]
                    own[0] = np.diff(own[0], prepend=0)  # both are sorted by their first column
                    rows.append((int(part[s]), is_far, e - s, *packed(own)))
            for s in range(0, len(rows), 256):
                kinds = (pa.int32(), pa.bool_(), pa.int32(), pa.list_(pa.int32()), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows[s:s + 256]), kinds)], names=["part", "far", "n", "widths", "data"])

        for batch in batches:
            for w in _joined(batch.column(0)):
                p, ok, n = w, w >= 0, 1
                words = ok
                # ok: here starts a frequent phrase of n words, and one starts at the next word
                for table in tables:
                    ok = ok[:-1] & ok[1:] & words[n:]
                    p = table.ids(p[: len(ok)], w[n:], ok)
                    ok, n = p >= 0, n + 1
                ok = ok[:-1] & ok[1:] & words[n:]
                if ok.any():
                    held.append((p[: len(ok)][ok], w[n:][ok]))
                    size += len(held[-1][0])
                if size >= RUN:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


def _add_pairs(cells: Cells, least: int, seed: int):
    """A group's packed pairs to its frequent ones (a, b, c, h); ``clash`` with a hash that others share."""

    def run(table: pa.Table) -> pa.Table:
        cell, far = [], []
        for is_far, n, widths, data in zip(*(table.column(k).to_pylist() for k in ("far", "n", "widths", "data"))):
            columns = unpacked(data, n, widths)
            columns[0] = np.cumsum(columns[0])
            (far if is_far else cell).append(columns)
        out = []
        if cell:
            number, c = (np.concatenate(x) for x in zip(*cell))
            order = np.argsort(number, kind="stable")
            number, c = number[order], c[order]
            first = np.flatnonzero(np.diff(number, prepend=-1))
            c = np.add.reduceat(c, first)
            often = c >= least
            number = number[first][often]
            out.append((*cells.pair(number), c[often], number | HASHED, np.zeros(len(number), bool)))
        if far:
            a, b, c = (np.concatenate(x) for x in zip(*far))
            h = pair_hash(a, b, seed) | FAR
            order = np.lexsort((b, a, h))
            a, b, c, h = a[order], b[order], c[order], h[order]
            first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
            a, b, c, h = a[first], b[first], np.add.reduceat(c, first), h[first]
            same = np.concatenate(([False], h[1:] == h[:-1], [False]))
            often = c >= least
            out.append((a[often], b[often], c[often], h[often], (same[1:] | same[:-1])[often]))
        return pa.table({k: np.concatenate(x) for k, x in zip(("a", "b", "c", "h", "clash"), zip(*out))})

    return run


def _bitmap(hashes: DataFrame) -> np.ndarray | None:
    """2**27 bits (16 MB whatever the number) with the places of the hashes; None without any."""
    place = F.col("h").bitwiseAND(F.lit((1 << BITS) - 1)) + 1
    rows = (hashes.select(F.bitmap_bucket_number(place).alias("k"), F.bitmap_bit_position(place).alias("p"))
            .groupBy("k").agg(F.bitmap_construct_agg("p").alias("bits")).collect())
    if not rows:
        return None
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        at = (r["k"] - 1) * len(part)
        out[at:at + len(part)] = part
    return out


def _clash(counted: DataFrame, least: int) -> bool:
    """Whether different rows (h, c) share a hash and one of them is frequent."""
    return not counted.groupBy("h").agg(F.count("*").alias("k"), F.max("c").alias("m")).filter(f"k > 1 AND m >= {least}").isEmpty()


def _hash_words(seed: int):
    def run(batches):
        for batch in batches:
            h = [word_hash(lang, w.encode(), seed) for lang, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h, pa.int64())], names=["lang", "word", "c", "h"])

    return run


def _ranked_words(counts: DataFrame, least: int, head: int):
    """Frequent words with ids (a DataFrame), and the broadcast form (ranks by language, bitmap, seed)."""
    frequent = counts.filter(F.col("c") >= least)
    short = frequent.filter(F.octet_length("word") <= LONG_WORD)
    top = short.orderBy(F.desc("c"), "lang", "word").limit(head).select("lang", "word").toArrow()
    langs, words = top.column(0).to_pylist(), top.column(1).to_pylist()
    ranks: dict[str, dict[bytes, int]] = {}
    for i, (lang, w) in enumerate(zip(langs, words)):
        ranks.setdefault(lang, {})[w.encode()] = i
    spark = counts.sparkSession
    listed = spark.createDataFrame(pa.table({"lang": pa.array(langs, pa.string()), "word": pa.array(words, pa.string()), "id": pa.array(range(len(words)), pa.int64())}))
    placed = frequent.join(listed, ["lang", "word"], "left")
    bitmap, seed = None, 0
    if not placed.filter("id IS NULL").isEmpty():
        for seed in range(8):
            hashed = counts.mapInArrow(_hash_words(seed), "lang string, word string, c long, h long")
            hashed = hashed.join(listed, ["lang", "word"], "left_anti")
            if not _clash(hashed, least):
                break
        else:
            raise RuntimeError("words kept sharing hashes")
        rest = hashed.filter(F.col("c") >= least)
        bitmap = _bitmap(rest)
        placed = placed.filter("id IS NOT NULL").unionByName(rest.withColumnRenamed("h", "id"))
    return placed.select("id", "lang", "word", "c"), (ranks, bitmap, seed)


def _frequent_pairs(sequences: DataFrame, levels, cells: Cells, least: int, groups: int, name: str) -> tuple[DataFrame, int]:
    """Frequent pairs (a, b, c, h) of the next level, and the seed of their hashes."""
    for seed in range(8):
        pairs = stored(sequences.mapInArrow(_count_pairs(list(levels), cells, groups, seed), PACKED)
                       .groupBy("part").applyInArrow(_add_pairs(cells, least, seed), "a long, b long, c long, h long, clash boolean"), name)
        if pairs.filter("clash").isEmpty():
            return pairs.drop("clash"), seed
    raise RuntimeError("phrases kept sharing hashes")


def _ranked_pairs(frequent: DataFrame, cells: Cells, seed: int):
    """Frequent pairs with ids (a DataFrame), and their table for tasks; (None, None) without any."""
    top = (frequent.filter((F.col("a") < cells.wide) & (F.col("b") < cells.head)).orderBy(F.desc("c"), "a", "b").limit(cells.wide)
           .select("a", "b").toArrow())
    a, b = (top.column(i).to_numpy().astype(np.int64) for i in (0, 1))
    spark = frequent.sparkSession
    listed = spark.createDataFrame(pa.table({"a": a, "b": b, "id": np.arange(len(a), dtype=np.int64)}))
    placed = frequent.join(listed, ["a", "b"], "left")
    rest = placed.filter("id IS NULL")
    bitmap = _bitmap(rest)
    if bitmap is None and not len(a):
        return None, None
    return placed.select(F.coalesce("id", "h").alias("id"), "a", "b", "c"), Level(a, b, cells, bitmap, seed)


def count_phrases(docs: DataFrame, least: int = 100, longest: int = 5, head: int = 1 << 16,
                  text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, n): all word occurrences; and (lang, words, c): every phrase of 1 to ``longest`` words that
    occurs at least ``least`` times in its language, words being an array."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = stored(texts.mapInArrow(_count_words, "lang string, word string, c long").groupBy("lang", "word").agg(F.sum("c").alias("c")), "words")
    totals = counts.groupBy("lang").agg(F.sum("c").alias("n"))
    placed, table = _ranked_words(counts, least, head)
    words = stored(placed, "ranked-words")
    occurrences = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    cells = Cells(head)
    groups = min(14, cells.bits, max(3, (int(occurrences) // GROUP).bit_length()))
    sequences = stored(texts.mapInArrow(_sequences(spark.sparkContext.broadcast(table)), "ids binary"), "sequences")
    before = stored(words.select("id", "lang", F.array("word").alias("words"), "c"), "phrases1")
    out, levels = [before], []
    for k in range(2, longest + 1):
        frequent, seed = _frequent_pairs(sequences, levels, cells, least, groups, f"pairs{k}")
        placed, level = _ranked_pairs(frequent, cells, seed)
        if placed is None:
            break
        first = before.select(F.col("id").alias("a"), "lang", "words")
        last = words.select(F.col("id").alias("b"), F.col("word"))
        before = stored(placed.join(first, "a").join(last, "b")
                        .select("id", "lang", F.concat("words", F.array("word")).alias("words"), "c"), f"phrases{k}")
        out.append(before)
        levels.append(spark.sparkContext.broadcast(level))  # each table travels once
    phrases = out[0]
    for p in out[1:]:
        phrases = phrases.unionByName(p)
    return totals, phrases.select("lang", "words", "c")


def mine(docs: DataFrame, least: int = 100, longest: int = 5, cover_percent: int = 100, top: int = 2000,
         head: int = 1 << 16, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``longest`` words by score,
    then frequency, both descending, then phrase in byte order.

    The score of a cut is floor(1000 * a * n / (l * r)), in exact decimals of 38 digits; the lowest cut
    counts.  A phrase inside a longer frequent one that has ``cover_percent`` % of its occurrences is
    dropped.  That need only be looked for in phrases one word longer: what lies between
    occurs at least as often as the longest."""
    totals, phrases = count_phrases(docs, least, longest, head, text_col, lang_col)
    wide = phrases.filter(F.size("words") > 1)
    n_words = F.size("words")
    shorter = (wide.filter(n_words > 2)
               .select("lang", "c", F.explode(F.array(F.slice("words", F.lit(1), n_words - 1), F.slice("words", F.lit(2), n_words - 1))).alias("words"))
               .groupBy("lang", "words").agg(F.max("c").alias("longer")))
    kept = (wide.join(shorter, ["lang", "words"], "left")
            .filter(F.expr(f"longer IS NULL OR 100 * longer < {cover_percent} * c")).select("lang", "words", F.col("c").alias("a")))
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), n_words - 1)))
    cuts = cuts.withColumns({"first": F.slice("words", F.lit(1), F.col("k")), "rest": F.slice("words", F.col("k") + 1, n_words - F.col("k"))})
    cuts = (cuts.join(phrases.select("lang", F.col("words").alias("first"), F.col("c").alias("l")), ["lang", "first"])
            .join(phrases.select("lang", F.col("words").alias("rest"), F.col("c").alias("r")), ["lang", "rest"])
            .join(totals, "lang"))
    wide_type = "decimal(19,0)"
    score = F.expr(f"(cast(a as {wide_type}) * cast(n * 1000 as {wide_type})) div (cast(l as {wide_type}) * cast(r as {wide_type}))")
    best = cuts.withColumn("score", score).groupBy("lang", "words").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("s"))
    rows = best.select("lang", F.array_join("words", " ").alias("phrase"), "s.a", "s.l", "s.r", "s.n", "s.score")
    # the best of each of SHARES shares of a language first, so at most top * SHARES rows meet in one task
    order = F.desc("score"), F.desc("a"), F.col("phrase")
    share = Window.partitionBy("lang", "_share").orderBy(*order)
    rows = (rows.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
            .withColumn("_nth", F.row_number().over(share)).filter(F.col("_nth") <= top))
    return (rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
