"""External induced sorting of the suffixes of many strings, with common-prefix values.

Suffixes are L-type (larger than the next suffix) or S-type; the leftmost of
each run of S-types (LMS) are sorted first, by naming the substrings between
them and recursing on the string of names, and induce all others: scanning
the sorted suffixes upwards, each puts its L-type predecessor behind the
suffixes already in the bucket of that predecessor's first character; a
second scan downwards does the same for S-types.  What waits to be scanned is
a priority queue of tuples (position, common prefix with its neighbour)
ordered by first character and then by arrival.  The queue is held in chunks,
and chunks beyond the memory budget lie in a file until their bucket comes up.

The common prefix of two neighbours that were induced by x and y is one more
than the least common prefix met between x and y, so one running minimum per
bucket carries it through the scans; only the seeds and the seams between the
L- and S-part of a bucket are compared directly.

Strings end in the separator 0.  Separators count as different characters,
smallest first, so nothing matches across strings.
"""

from __future__ import annotations

import heapq
import tempfile
from collections import defaultdict, deque

import numpy as np

from starloom.llm.common import prefix_hash, span_hash


CHUNK = 1 << 20  # suffixes scanned at a time


class DiskQueue:
    """Monotone priority queue by character: FIFO within one character, chunks spilled to disk."""

    def __init__(self, budget: int):
        self.budget, self.held, self.end = budget, 0, 0
        self.buckets: dict[int, deque] = defaultdict(deque)
        self.file = None

    def push(self, char: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.buckets[char].append((pos, lcp))
        self.held += pos.nbytes + lcp.nbytes
        if self.held > self.budget:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()  # noqa: SIM115 - closed with the queue
        self.file.seek(self.end)
        for chunks in self.buckets.values():
            for i, chunk in enumerate(chunks):
                if isinstance(chunk[0], np.ndarray):
                    pos, lcp = chunk
                    self.file.write(pos.tobytes())
                    self.file.write(lcp.tobytes())
                    chunks[i] = (self.end, len(pos))
                    self.end += pos.nbytes + lcp.nbytes
        self.held = 0

    def _load(self, chunk) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(chunk[0], np.ndarray):
            self.held -= chunk[0].nbytes + chunk[1].nbytes
            return chunk
        at, n = chunk
        self.file.seek(at)
        return (np.frombuffer(self.file.read(8 * n), np.int64), np.frombuffer(self.file.read(4 * n), np.int32))

    def pop(self, char: int, last: bool = False):
        """Chunks of a character in order of arrival, those pushed meanwhile included; last: from the newest."""
        chunks = self.buckets.get(char)
        while chunks:
            some, n = [], 0
            while chunks and n < CHUNK:  # small chunks are scanned together
                some.append(self._load(chunks.pop() if last else chunks.popleft()))
                n += len(some[-1][0])
            some = some[::-1] if last else some
            yield some[0] if len(some) == 1 else (np.concatenate([x[0] for x in some]), np.concatenate([x[1] for x in some]))
        self.buckets.pop(char, None)

    def close(self) -> None:
        if self.file:
            self.file.close()


class _Carry:
    """For each bucket the least common prefix met since its newest suffix was put in."""

    def __init__(self, alphabet: int):
        self.least = np.full(alphabet, np.iinfo(np.int32).max, np.int32)
        self.used = np.zeros(alphabet, bool)

    def induce(self, chars: np.ndarray, at: np.ndarray, lcp: np.ndarray):
        """chars[i] is induced by scan item at[i]; lcp: of all scan items with the one before.
        Yields (char, indices into at, their common prefix with the one before them in the bucket)."""
        padded = np.append(lcp, np.iinfo(np.int32).max).astype(np.int32)
        if not len(at):
            self.least = np.minimum(self.least, padded.min())
            return
        order = np.argsort(chars, kind="stable")
        ch, src = chars[order], at[order]
        first = np.ones(len(ch), bool)
        first[1:] = ch[1:] != ch[:-1]
        lo = np.empty(len(ch), np.int64)
        lo[1:] = src[:-1] + 1
        lo[first] = 0
        spans = np.empty(2 * len(ch), np.int64)
        spans[0::2], spans[1::2] = lo, src + 1
        least = np.minimum.reduceat(padded, spans)[0::2]
        heads = np.flatnonzero(first)
        kinds = ch[heads]
        known = self.used[kinds]
        own = 1 + least
        own[heads] = np.where(known, 1 + np.minimum(self.least[kinds], least[heads]), 0)
        ends = np.append(heads[1:], len(ch))
        self.least = np.minimum(self.least, padded.min())
        tails = src[ends - 1] + 1
        pairs = np.empty(2 * len(tails), np.int64)
        pairs[0::2], pairs[1::2] = tails, len(padded) - 1
        rest = np.minimum.reduceat(padded, pairs)[0::2]
        self.least[kinds] = np.where(tails < len(lcp), rest, np.iinfo(np.int32).max)
        self.used[kinds] = True
        for k, a, b in zip(kinds.tolist(), heads.tolist(), ends.tolist()):
            yield k, order[a:b], own[a:b]


def _is_s(text: np.ndarray) -> np.ndarray:
    """S-type of every position; separators are S-type."""
    n = len(text)
    out = np.zeros(n, bool)
    diff = np.empty(n, np.int8)
    diff[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1])
    diff[-1] = 1
    diff[text == 0] = 1
    # an equal neighbour takes the type of the next place that differs
    place = np.where(diff != 0, np.arange(n), n - 1)
    nxt = np.minimum.accumulate(place[::-1])[::-1]
    out[:] = diff[nxt] > 0
    return out


class Comparer:
    """Direct common prefixes, eight bytes at a time, never past the end of either string."""

    def __init__(self, text: np.ndarray, cap: int):
        self.text, self.cap = text, cap
        width = text.dtype.itemsize
        self.step = 8 // width
        padded = np.concatenate((text, np.zeros(2 * self.step, text.dtype)))
        raw = padded.view(np.uint8)
        self.words = np.lib.stride_tricks.as_strided(raw, (len(text) + self.step, 8), (width, 1))
        ends = np.flatnonzero(text == 0)
        self.ends = ends
        self.width = width

    def _at(self, p: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(self.words[np.minimum(p, len(self.text) - 1)]).view(np.uint64).ravel()

    def __call__(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        most = np.minimum(self.ends[np.searchsorted(self.ends, p)] - p, self.ends[np.searchsorted(self.ends, q)] - q)
        most = np.minimum(most, self.cap)
        out = np.zeros(len(p), np.int64)
        act = np.flatnonzero(most > 0)
        while len(act):
            x = self._at(p[act] + out[act]) ^ self._at(q[act] + out[act])
            same = x == 0
            low = x[~same]
            bit = np.log2((low & (~low + np.uint64(1))).astype(np.float64)).astype(np.int64)
            out[act[~same]] += bit // (8 * self.width)
            out[act[same]] += self.step
            act = act[same]
            act = act[out[act] < most[act]]
        return np.minimum(out, most).astype(np.int32)


def _scan_chunks(pos: np.ndarray, lcp: np.ndarray):
    for i in range(0, len(pos), CHUNK):
        yield pos[i:i + CHUNK], lcp[i:i + CHUNK]


def _induce(text: np.ndarray, s_type: np.ndarray, seeds: np.ndarray, seed_lcp: np.ndarray, compare, budget: int, visit) -> None:
    """Scan up for L-types, then down for S-types; visit(positions, common prefix with the
    one visited before) gets all suffixes but separators from the largest to the smallest."""
    alphabet = int(text.max()) + 1
    waiting, settled = DiskQueue(budget // 2), DiskQueue(budget // 2)
    carry = _Carry(alphabet)
    seed_at = text[seeds]
    bounds = np.flatnonzero(np.append(True, seed_at[1:] != seed_at[:-1])) if len(seeds) else np.zeros(0, np.int64)
    seed_of = {int(seed_at[a]): (a, b) for a, b in zip(bounds.tolist(), np.append(bounds[1:], len(seeds)).tolist())}
    todo = sorted(seed_of)
    heapq.heapify(todo)
    known = set(todo)
    seam = lambda p, q: int(compare(np.array([p]), np.array([q]))[0]) if compare else 0

    def scan(pos, lcp, want_s):
        before = pos - 1
        ok = before >= 0
        char = text[np.maximum(before, 0)]
        ok &= (char != 0) & (s_type[np.maximum(before, 0)] == want_s)
        at = np.flatnonzero(ok)
        for c, which, own in carry.induce(char[at].astype(np.int64), at, lcp):
            waiting.push(c, before[at[which]], own.astype(np.int32))
            if c not in known:
                known.add(c)
                heapq.heappush(todo, -c if want_s else c)

    large = []
    while todo:
        char = heapq.heappop(todo)
        large.append(char)
        last = None
        for pos, lcp in waiting.pop(char):
            settled.push(char, pos, lcp)
            last = int(pos[-1])
            for p, l in _scan_chunks(pos, lcp):  # noqa: E741
                scan(p, l, False)
        a, b = seed_of.get(char, (0, 0))
        if b > a:
            lcp = seed_lcp[a:b].copy()
            lcp[0] = seam(last, seeds[a]) if last is not None and char else 0
            for p, l in _scan_chunks(seeds[a:b], lcp):  # noqa: E741
                scan(p, l, False)
    carry = _Carry(alphabet)
    todo = [-c for c in large]
    heapq.heapify(todo)
    while todo:
        char = -heapq.heappop(todo)
        if char == 0:
            continue
        last, after = None, None
        for pos, lcp in waiting.pop(char):
            visit(pos, lcp)
            last = int(pos[-1])
            for p, l in _scan_chunks(pos, lcp):  # noqa: E741
                scan(p, l, True)
        for pos, lcp in settled.pop(char, last=True):
            down = pos[::-1].copy()
            lcp_down = np.empty(len(down), np.int32)
            lcp_down[1:] = lcp[::-1][:-1]
            # the first one's neighbour above: the smallest S-type, or the next chunk of the bucket
            lcp_down[0] = after if after is not None else (seam(int(down[0]), last) if last is not None else 0)
            after = int(lcp[0])
            visit(down, lcp_down)
            for p, l in _scan_chunks(down, lcp_down):  # noqa: E741
                scan(p, l, True)
    waiting.close()
    settled.close()


def _doubled(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names that fits in memory; separators (0) are unique."""
    n = len(names)
    sep = names == 0
    rank = names.astype(np.int64) + int(sep.sum())
    rank[sep] = np.arange(int(sep.sum()))
    k = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-k] = rank[k:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        step = np.append(0, np.cumsum(key[order][1:] != key[order][:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = step
        if step[-1] == n - 1 or k >= n:
            return order
        k *= 2


def sorted_lms(text: np.ndarray, s_type: np.ndarray, budget: int, in_memory: int) -> np.ndarray:
    """LMS positions in order of their suffixes."""
    lms = np.flatnonzero(s_type & np.append(False, ~s_type[:-1]))
    by_char = lms[np.argsort(text[lms], kind="stable")]
    got: list[np.ndarray] = []
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    _induce(text, s_type, by_char, np.zeros(len(by_char), np.int32), None, budget, lambda pos, lcp: got.append(pos[is_lms[pos]]))
    order = np.concatenate(got)[::-1] if got else np.zeros(0, np.int64)  # by LMS substring, without separators
    ends = np.append(lms[1:], len(text) - 1)
    end_of = np.zeros(len(text), np.int64)
    end_of[lms] = ends
    prefix = prefix_hash(text) if text.dtype == np.uint8 else _wide_prefix(text)
    stop = np.minimum(end_of[order] + 1, len(text))
    code = span_hash(prefix, order, stop)
    new = np.ones(len(order), np.int64)
    # two substrings that run into their separators are different even if they look equal
    new[1:] = (code[1:] != code[:-1]) | (text[end_of[order[1:]]] == 0)
    names = np.zeros(len(text), np.int64)
    names[order] = np.cumsum(new)
    reduced = names[lms]  # separators keep 0
    if len(order) == 0 or new.all():
        rank = np.concatenate((lms[text[lms] == 0], order))
        return rank
    if len(reduced) <= in_memory:
        return lms[_doubled(reduced)]
    found: list[np.ndarray] = []
    reduced = reduced.astype(np.int32)
    kinds = _is_s(reduced)
    seeds = sorted_lms(reduced, kinds, budget, in_memory)
    _induce(reduced, kinds, seeds, np.zeros(len(seeds), np.int32), None, budget, lambda pos, lcp: found.append(pos))
    return np.concatenate((lms[reduced == 0], lms[np.concatenate(found)[::-1]]))


def _wide_prefix(text: np.ndarray) -> np.ndarray:
    """Prefix hashes of a string of names."""
    from starloom.llm.common import mix, powers

    r, _ = powers(len(text) + 1)
    out = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(mix(text.astype(np.uint64)) * r[: len(text)], out=out[1:])
    return out


def visit_suffixes(text: np.ndarray, visit, cap: int = 1 << 30, budget: int = 64 << 20, in_memory: int = 4 << 20) -> None:
    """visit(positions, common prefix with the suffix visited before) for all suffixes of the
    0-terminated strings in ``text`` (uint8), from the largest to the smallest; common
    prefixes of seeds are counted up to ``cap``."""
    if not len(text):
        return
    s_type = _is_s(text)
    seeds = sorted_lms(text, s_type, budget, in_memory)
    compare = Comparer(text, cap)
    lcp = np.zeros(len(seeds), np.int32)
    if len(seeds) > 1:
        for i in range(1, len(seeds), 1 << 19):
            j = min(len(seeds), i + (1 << 19))
            lcp[i:j] = compare(seeds[i - 1:j - 1], seeds[i:j])
    _induce(text, s_type, seeds, lcp, compare, budget, visit)
