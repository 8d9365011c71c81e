"""Benchmark decontamination: BM25 retrieval of test items by block-max WAND, then overlap checks.

The test items are the small side: an inverted index over their words is built
from them and broadcast in blocks of items, each block below a checked size
(more items mean more passes over the corpus, never a larger broadcast).  Every
document is cut into overlapping passages and each passage is a query.  Scores
are BM25 with the passage's distinct words; an item's threshold is a share
``least`` of the score that the item itself would get, so it means the same
for short and long items.

Block-max WAND: items are numbered by length, and each posting list is cut into
blocks of item numbers with the block's greatest share of the threshold.  Over
a batch of passages at once, the sums of the words' greatest shares in each of at
most ``RANGES`` ranges of items are taken; where a sum stays below 1 no item of the
range can be retrieved (nearly always).  In the ranges left, lists are merged by
pivot, blocks whose bounds stay below 1 are skipped, and only the rest is scored
in full.  All items at or above the threshold are retrieved, there is no top-k.

A retrieved item is confirmed on the whole document: of its question (all but
the last sentence, or the first two thirds if it is one sentence) and of its answer
(the rest) at least ``overlap`` of the word n-grams must occur in the document.

Defined results
* null, empty or short text: retrieves nothing, is clean.
* words are letter and digit runs, lower-cased; case and punctuation don't hide a leak.
* items without words match nothing; equal items are all reported.
* an empty benchmark leaves every document clean.
* every row is judged by itself, so repeated rows and null ids keep their rows;
  other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+")
K1, B = 1.2, 0.75
RANGES = 64


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The item's words before and from its last sentence."""
    words = tokens(text)
    parts = [p for p in SENTENCE.split(text or "") if tokens(p)]
    n = len(tokens(parts[-1])) if len(parts) > 1 else len(words) - (2 * len(words) + 2) // 3
    n = max(n, min(len(words), 1))
    return words[:len(words) - n], words[len(words) - n:]


class Index:
    """Inverted index of a block of test items: for each word its items, their BM25 weights as
    shares of the items' thresholds, and the greatest share in every block of postings.
    ``items``: (id, text to retrieve by, whole text)."""

    def __init__(self, items: list[tuple[int, str, str]], frequency: dict[str, int], n_items: int, average: float,
                 least: float, block: int = 16, n: int = 5):
        self.ids = [i for i, _, _ in items]
        self.parts = [question_and_answer(t) for _, _, t in items]
        self.n = n
        lists: dict[str, list] = defaultdict(list)
        for number, (_, text, _) in enumerate(items):
            words = tokens(text)
            count: dict[str, int] = defaultdict(int)
            for w in words:
                count[w] += 1
            scale = K1 * (1 - B + B * len(words) / max(average, 1e-9))
            weights = {w: np.log(1 + (n_items - frequency[w] + 0.5) / (frequency[w] + 0.5)) * c * (K1 + 1) / (c + scale) for w, c in count.items()}
            total = sum(weights.values())
            for w, v in weights.items():
                lists[w].append((number, v / (least * total)))
        self.number = {w: i for i, w in enumerate(lists)}
        self.items = [np.array([p[0] for p in ps]) for ps in lists.values()]
        self.shares = [np.array([p[1] for p in ps]) for ps in lists.values()]
        self.block_last = [x[block - 1::block] if len(x) % block == 0 else np.append(x[block - 1::block], x[-1]) for x in self.items]
        self.block_most = [np.maximum.reduceat(s, np.arange(0, len(s), block)) for s in self.shares]
        # ranges of item numbers and each word's greatest share in them
        self.width = max(1, -(-len(items) // RANGES))
        self.most = np.zeros((len(lists), -(-len(items) // self.width)))
        for t, (numbers, shares) in enumerate(zip(self.items, self.shares)):
            np.maximum.at(self.most[t], numbers // self.width, shares)

    def retrieve(self, terms, part: int) -> list[int]:
        """Items of range ``part`` whose shares over the distinct ``terms`` sum to 1 or more, by block-max WAND."""
        most = self.most[:, part]
        low, end = part * self.width, (part + 1) * self.width
        lists = [[t, int(np.searchsorted(self.items[t], low))] for t in terms if most[t] > 0]  # term, place in its postings
        found = []
        while lists:
            lists.sort(key=lambda x: self.items[x[0]][x[1]])
            bound, pivot = 0.0, -1
            for i, (t, _) in enumerate(lists):
                bound += most[t]
                if bound >= 1 - 1e-9:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = int(self.items[lists[pivot][0]][lists[pivot][1]])
            while pivot + 1 < len(lists) and self.items[lists[pivot + 1][0]][lists[pivot + 1][1]] == item:
                pivot += 1
            blocks = [(t, int(np.searchsorted(self.block_last[t], item))) for t, _ in lists[:pivot + 1]]
            blocks = [(t, b) for t, b in blocks if b < len(self.block_last[t])]
            if sum(self.block_most[t][b] for t, b in blocks) >= 1 - 1e-9:
                score = 0.0
                for x in lists[:pivot + 1]:
                    x[1] += int(np.searchsorted(self.items[x[0]][x[1]:], item))
                    if x[1] < len(self.items[x[0]]) and self.items[x[0]][x[1]] == item:
                        score += self.shares[x[0]][x[1]]
                        x[1] += 1
                if score >= 1 - 1e-9:
                    found.append(item)
            else:
                # nothing up to the end of the nearest of these blocks, or before the next list, can reach 1
                ends = [int(self.block_last[t][b]) + 1 for t, b in blocks]
                if pivot + 1 < len(lists):
                    ends.append(int(self.items[lists[pivot + 1][0]][lists[pivot + 1][1]]))
                to = max(item + 1, min(ends))
                for x in lists[:pivot + 1]:
                    x[1] += int(np.searchsorted(self.items[x[0]][x[1]:], to))
            lists = [x for x in lists if x[1] < len(self.items[x[0]]) and self.items[x[0]][x[1]] < end]
        return found

    def confirmed(self, item: int, grams: dict[int, set], words: list[str], overlap: float) -> bool:
        """Question and answer n-grams of the item that the document has."""
        for part in self.parts[item]:
            n = min(self.n, len(part))
            if n == 0:
                continue
            if n not in grams:
                grams[n] = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}
            own = {tuple(part[i:i + n]) for i in range(len(part) - n + 1)}
            if len(own & grams[n]) < overlap * len(own):
                return False
        return True


def _retrieved(index: Index, texts: list[np.ndarray], width: int) -> list[set[int]]:
    """The items that any passage of each text (word numbers, -1: no item has the word) retrieves."""
    hits: list[set[int]] = [set() for _ in texts]
    owner, terms, first = [], [], 0
    text_of = []
    for i, ids in enumerate(texts):
        half = np.arange(len(ids)) // width
        passages = max(1, -(-len(ids) // width) - 1)
        known = ids >= 0
        half, ids = half[known], ids[known]
        # a half belongs to the passage that starts with it and to the one that ends with it
        for shift in (0, 1):
            ok = (half - shift >= 0) & (half - shift < passages)
            owner.append(first + half[ok] - shift)
            terms.append(ids[ok])
        text_of += [i] * passages
        first += passages
    if not index.ids or not owner:
        return hits
    n = len(index.most)
    pairs = np.unique(np.concatenate(owner) * n + np.concatenate(terms))
    if not len(pairs):
        return hits
    owner, terms = pairs // n, pairs % n
    heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    ends = np.append(heads[1:], len(owner))
    bounds = np.add.reduceat(index.most[terms], heads, axis=0)
    for p, part in zip(*np.nonzero(bounds >= 1 - 1e-9)):
        hits[text_of[owner[heads[p]]]].update(index.retrieve(terms[heads[p]:ends[p]].tolist(), int(part)))
    return hits


def _leaks(model, width: int, overlap: float, last: bool):
    """One block of items against every document: passages of ``2 * width`` words, each starting
    ``width`` words after the one before.  Columns: text, n_passages, n_retrieved, items, others."""

    def run(batches):
        index: Index = model.value
        get = index.number.get
        for batch in batches:
            found, n_passages, n_found = [], [], []
            for a in range(0, len(batch), 256):
                texts, _, n_before, before = (batch.column(i).slice(a, 256).to_pylist() for i in range(4))
                words = [tokens(t) for t in texts]
                hits = _retrieved(index, [np.array([get(w, -1) for w in ws], np.int64) for ws in words], width)
                for i, ws in enumerate(words):
                    n_passages.append(max(1, -(-len(ws) // width) - 1) if ws else 0)
                    n_found.append(n_before[i] + len({index.ids[j] for j in hits[i]}))
                    grams: dict[int, set] = {}
                    found.append(sorted({*before[i], *(index.ids[j] for j in hits[i] if index.confirmed(j, grams, ws, overlap))}))
            columns = [batch.column(0), pa.array(n_passages, pa.int64()), pa.array(n_found, pa.int64()), pa.array(found, pa.list_(pa.int64())), *batch.columns[4:]]
            yield pa.RecordBatch.from_arrays(columns[last:], names=batch.schema.names[last:])

    return run


def index_blocks(benchmark: DataFrame, least: float, width: int, block_bytes: int, item_col: str = "item_id", text_col: str = "text") -> list[Index]:
    """Indexes of consecutive items, each over at most ``block_bytes`` of item text unless one item
    is larger; word statistics are of all items.  Items over a passage's length are retrieved by any
    of their stretches and confirmed as a whole."""
    rows = benchmark.select(F.col(item_col).cast("long"), F.col(text_col).cast("string")).orderBy(item_col, text_col)
    items, frequency, length = [], defaultdict(int), 0
    for number, text in rows.toLocalIterator():
        words = tokens(text)
        if number is None or not words:
            continue
        length += len(words)
        for w in set(words):
            frequency[w] += 1
        step = 2 * width
        items += [(number, " ".join(words[i:i + step]), text) for i in range(0, len(words), step)]
    blocks, size = [[]], 0
    for item in sorted(items, key=lambda x: (len(x[1]), x[0])):
        if blocks[-1] and size + len(item[2]) > block_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append(item)
        size += len(item[2])
    return [Index(b, frequency, len(items), length / max(len(items), 1), least) for b in blocks]


def find_leaks(docs: DataFrame, benchmark: DataFrame, least: float = 0.6, overlap: float = 0.6, width: int = 48,
               block_bytes: int = 8 << 20, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns, n_passages, n_retrieved (items above the threshold) and items (ids of the
    confirmed ones) for every row of ``docs``.  Blocks of items follow one another in the same pass."""
    spark = docs.sparkSession
    out = docs.select(F.col("text").cast("string").alias("_text"), F.lit(0).cast("long").alias("n_passages"), F.lit(0).cast("long").alias("n_retrieved"),
                      F.array().cast("array<bigint>").alias("items"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)])
    blocks = index_blocks(benchmark, least, width, block_bytes)
    for i, index in enumerate(blocks):
        last = i == len(blocks) - 1  # the text goes no further
        fields = out.schema.fields[last:]
        out = out.mapInArrow(_leaks(spark.sparkContext.broadcast(index), width, overlap, last),
                             ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields))
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], "n_passages", "n_retrieved", "items")
