"""PII: base patterns, and a character-level BiLSTM-CRF that finds what they miss.

The base finds emails, IP addresses, cards and phone numbers by fixed patterns
and checks.  The model is trained on labelled spans: windows around base matches of
at most ``bound`` documents, and windows into which generated spans in less regular
notations (spaced, bracketed, other separators, no prefix) are set.  It reads
characters both ways and a CRF scores tag sequences.

A span of any of the four kinds holds a digit or an at sign (or a bracketed "at"),
so text without one within ``REACH`` characters cannot hold a span and is
tagged O by definition; everything else of a text, however long, lies in windows
that overlap by half.  Scores of a character seen in two windows are averaged,
weighted towards a window's middle, and each connected stretch is decoded once as
a whole, so spans across window borders come out in one piece.  Decoded spans are
added if they pass their kind's plausibility check and touch no base span.

Defined results
* null or empty text: no spans; base_sha256 is the hash of no bytes, spans is empty.
* offsets count code points, ends are exclusive; counts are of base spans, n_added of the model's.
* matches that fail their check are dropped and not retried from a later start.
* null doc_id: scored, never sampled for training; repeated rows get equal results.
* no document with a digit or at sign: trained on generated spans only.
* other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded_sample
from starloom.llm.tagger import Tagger

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match never starts inside a run of digits: the run's first digit would have matched too
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]|[\[(]\s?(?:at|AT)\s?[\])]")
WINDOW, REACH = 96, 48

# symbols: 0 padding, 1-26 letters of either case, then these signs, then classes
SIGNS = " \n@.-+()[]_%:/,;'\"#*|&=<>!?$"
OTHER, DIGIT, WIDE, CAPITAL = 27 + len(SIGNS), 28 + len(SIGNS), 29 + len(SIGNS), 30 + len(SIGNS)
SYMBOLS = CAPITAL + 26
_CODE = np.full(128, OTHER, np.int16)
for _i in range(26):
    _CODE[97 + _i], _CODE[65 + _i] = 1 + _i, CAPITAL + _i
for _i, _c in enumerate(SIGNS):
    _CODE[ord(_c)] = 27 + _i
_CODE[48:58] = DIGIT


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind and start."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append((3, *m.span()))
    return out


def codes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CODE[np.minimum(points, 127)], WIDE)


def plausible(kind: int, span: str) -> bool:
    """Whether a decoded span can be what its tag says."""
    digits = re.sub("[^0-9]", "", span)
    if kind == 0:
        return bool(re.fullmatch(r"[^\s@]+\s?(?:@|[\[(]\s?(?:at|AT)\s?[\])])\s?[^\s@]+(?:\s?(?:\.|[\[(]\s?(?:dot|DOT)\s?[\])])\s?[^\s@.]+)+", span))
    if kind == 1:
        parts = re.findall("[0-9]+", span)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) and not re.search("[A-Za-z]", span)
    if kind == 2:
        return 16 <= len(digits) <= 19 and luhn(digits) and not re.search("[A-Za-z]", span)
    return 8 <= len(digits) <= 15 and not re.search("[A-Za-z]", span) and bool(re.match(r"[+(0-9]", span))


# ---- training windows -------------------------------------------------------

def _generated(rng) -> tuple[int, str]:
    """A span in one of the notations, regular or not."""
    number = lambda n: "".join(rng.choice(list("0123456789"), n))
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(3, 9))))
    kind = int(rng.integers(0, 4))
    if kind == 0:
        user = word() + rng.choice(["", ".", "_", "-"]) + rng.choice([word(), number(2), ""])
        at = rng.choice(["@", "@", " @ ", "[at]", "(at)", " [at] ", "@ "])
        dot = rng.choice([".", ".", "[dot]", " . "]) if at != "@" else "."
        return kind, user.rstrip("._-") + at + word() + dot + rng.choice(["com", "org", "net", "example"])
    if kind == 1:
        return kind, rng.choice([".", ".", " . ", "[.]", ". "]).join(str(rng.integers(0, 256)) for _ in range(4))
    if kind == 2:
        digits = number(15)
        digits += next(d for d in "0123456789" if luhn(digits + d))
        return kind, rng.choice(["", " ", "-", ".", "  ", "/"]).join(digits[i:i + 4] for i in range(0, 16, 4))
    parts = [number(n) for n in (int(rng.integers(1, 4)), 3, 3, 4)]
    shape = rng.choice(["+{} {} {} {}", "+{}-{}-{}-{}", "00{} {} {} {}", "({1}) {2}-{3}", "{1}-{2}-{3}", "+{}/{}/{}/{}", "+ {} {} {} {}"])
    return kind, str(shape).format(*parts)


def _tags(length: int, spans) -> np.ndarray:
    """0 outside; 1 + 2 * kind where a span begins, 2 + 2 * kind inside it."""
    out = np.zeros(length, np.int64)
    for kind, a, b in spans:
        a, b = max(a, 0), min(b, length)
        if a < b:
            out[a:b] = 2 + 2 * kind
            out[a] = 1 + 2 * kind
    return out


def training_set(texts: list[str], generated: int = 1600, seed: int = 44) -> tuple[np.ndarray, np.ndarray]:
    """Windows of codes and tags: around base matches of ``texts``, and with generated spans set into them."""
    rng = np.random.default_rng(seed)
    codes, tags, carriers = [], [], []

    def add(window: str, spans):
        window = window[:WINDOW]
        codes.append(np.pad(codes_of(window), (0, WINDOW - len(window))))
        tags.append(np.pad(_tags(len(window), spans), (0, WINDOW - len(window))))

    for text in texts:
        spans = base_spans(text)
        for kind, a, b in spans[:3]:
            lo = max(0, a - int(rng.integers(10, WINDOW - 30)))
            add(text[lo:lo + WINDOW], [(k, x - lo, y - lo) for k, x, y in spans])
        for m in list(TRIGGER.finditer(text))[:40:13]:  # numbers that are nothing
            lo = max(0, m.start() - int(rng.integers(10, WINDOW - 20)))
            add(text[lo:lo + WINDOW], [(k, x - lo, y - lo) for k, x, y in spans])
        lo = int(rng.integers(0, max(1, len(text) - WINDOW)))
        if not TRIGGER.search(text[lo:lo + WINDOW]):
            carriers.append(text[lo:lo + WINDOW])
    letters = list("abcdefghijklmnopqrstuvwxyz")
    carriers = carriers or ["words of a text that hold nothing in particular, one after the other until the window is full of them"]
    for _ in range(generated):
        carrier = carriers[int(rng.integers(0, len(carriers)))]
        if rng.random() < 0.5:  # words of any letters, so that the corpus' own words are not the only ones outside spans
            carrier = " ".join("".join(rng.choice(letters, int(rng.integers(1, 10)))) for _ in range(18))[:WINDOW]
        at = int(rng.integers(0, len(carrier) + 1))
        kind, span = _generated(rng)
        gap = str(rng.choice([" ", " ", ", ", ": ", "\n"]))
        window = carrier[:at] + gap + span + str(rng.choice([" ", ". ", ", ", "\n"])) + carrier[at:]
        shift = max(0, at + len(gap) + len(span) + 5 - WINDOW)
        add(window[shift:], [(kind, at + len(gap) - shift, at + len(gap) + len(span) - shift)])
    return np.stack(codes).astype(np.int64), np.stack(tags)


# ---- tagging ---------------------------------------------------------------

def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text within REACH of a digit, at sign or bracketed at."""
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_CENTRE = np.minimum(np.arange(WINDOW) + 1, np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]


def decoded(tagger: Tagger, parts: list[np.ndarray]) -> list[np.ndarray]:
    """Tags of stretches of codes: overlapping windows are scored, averaged, and each stretch decoded once."""
    windows, places = [], []
    for i, c in enumerate(parts):
        for a in range(0, max(1, len(c) - WINDOW // 2), WINDOW // 2):
            w = c[a:a + WINDOW]
            windows.append(np.pad(w, (0, WINDOW - len(w))))
            places.append((i, a, len(w)))
    scores = [np.zeros((len(c), len(tagger.p["u"])), np.float32) for c in parts]
    seen = [np.zeros((len(c), 1), np.float32) for c in parts]
    for s in range(0, len(windows), 512):
        e = tagger.emissions(np.stack(windows[s:s + 512]))
        for (i, a, n), x in zip(places[s:s + 512], e):
            scores[i][a:a + n] += x[:n] * _CENTRE[:n]
            seen[i][a:a + n] += _CENTRE[:n]
    out: list = [None] * len(parts)
    order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
    at = 0
    while at < len(order):
        group = [order[at]]
        longest = max(len(parts[order[at]]), WINDOW)
        while at + len(group) < len(order) and len(group) < 256 and len(parts[order[at + len(group)]]) <= 2 * longest:
            group.append(order[at + len(group)])
        lengths = np.array([len(parts[i]) for i in group])
        e = np.zeros((len(group), lengths.max(), scores[0].shape[1]), np.float32)
        for row, i in enumerate(group):
            e[row, : lengths[row]] = scores[i] / seen[i]
        for i, tags in zip(group, tagger.decode(e, lengths)):
            out[i] = tags
        at += len(group)
    return out


def added_spans(text: str, found: list[tuple[int, np.ndarray]], base) -> list[tuple[int, int, int]]:
    """Decoded spans that are plausible and touch no base span."""
    taken = sorted((a, b) for _, a, b in base)
    out = []
    for begin, tags in found:
        at = 0
        while at < len(tags):
            if tags[at] == 0:
                at += 1
                continue
            kind = (int(tags[at]) - 1) // 2
            end = at + 1
            while end < len(tags) and tags[end] == 2 + 2 * kind:
                end += 1
            a, b = begin + at, begin + end
            while a < b and text[a] in " \n,;:":
                a += 1
            while a < b and text[b - 1] in " \n,;:.":
                b -= 1
            if a < b and not any(x < b and a < y for x, y in taken) and plausible(kind, text[a:b]):
                out.append((kind, a, b))
            at = end
    return out


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _found(model):
    def run(batches):
        tagger: Tagger = model.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = [[[], [], ""] for _ in texts]
            part_of, parts = [], []

            def flush():
                for (i, a), tags in zip(part_of, decoded(tagger, parts) if parts else []):
                    rows[i][1].append((a, tags))
                part_of.clear()
                parts.clear()

            for i, text in enumerate(texts):
                if not text or not TRIGGER.search(text):
                    continue
                rows[i][0] = base_spans(text)
                for a, b in stretches(text):
                    part_of.append((i, a))
                    parts.append(codes_of(text[a:b]))
                if sum(map(len, parts)) > 1 << 18:
                    flush()
            flush()
            counts, sha, spans, more = [[] for _ in KINDS], [], [], []
            for text, (base, found, _) in zip(texts, rows):
                extra = added_spans(text, found, base) if found else []
                for k, col in enumerate(counts):
                    col.append(sum(s[0] == k for s in base))
                sha.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined([*base, *extra]))
                more.append(len(extra))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(sha), pa.array(spans), pa.array(more, pa.int64())],
                                             names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return run


def learn(docs: DataFrame, bound: int = 300) -> Tagger:
    """Trained on at most ``bound`` documents that hold a digit or at sign, and on generated spans."""
    ids = [r[0] for r in bounded_sample(docs.filter(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@]")).select("doc_id").distinct(),
                                        F.col("doc_id"), bound).select("doc_id").collect()]
    texts = docs.filter(F.col("doc_id").isin(ids)).dropDuplicates(["doc_id"]).orderBy("doc_id").select("text").collect() if ids else []
    codes, tags = training_set([r[0] for r in texts])
    tagger = Tagger(SYMBOLS, 1 + 2 * len(KINDS))
    tagger.train(codes, tags)
    return tagger


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train: DataFrame | None = None, **options) -> DataFrame:
    """doc_id, base counts n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added for every row of
    ``docs``; trained on documents of ``train`` (doc_id, text), by default on ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(learn(rows if train is None else train, **options))
    return rows.mapInArrow(_found(model), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
