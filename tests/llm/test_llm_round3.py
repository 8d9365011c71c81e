"""Collocations, SentencePiece and whitening against brute force, the library and an eigen decomposition."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece

import public_tokenizers
from conftest import SF_SMALL
from starloom.llm import collocation, sentencepiece_bpe, whitening
from starloom.llm.entries import op12_sentencepiece
from test_llm_operators import SCHEMA, rows

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


# ---- 11 -----------------------------------------------------------------------

def brute_phrases(texts, least, longest=5, top=2000):
    n, f = Counter(), Counter()
    for lang, text in texts:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cand = {p: c for p, c in f.items() if len(p[1]) > 1 and c >= least}
    gone = {(lang, w[i:j]) for (lang, w), c in cand.items() for i in range(len(w)) for j in range(i + 2, len(w) + 1)
            if j - i < len(w) and (lang, w[i:j]) in cand and 100 * c >= 100 * cand[lang, w[i:j]]}
    out = {}
    for (lang, w), a in cand.items():
        if (lang, w) not in gone:
            score, _, left, right = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return {(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, ps in out.items() for i, (s, a, p, x, y) in enumerate(sorted(ps)[:top])}


@pytest.mark.parametrize("head,least,top", [(1 << 16, 3, 2000), (5, 3, 2000), (40, 6, 7)])
def test_phrases(docs, head, least, top):
    """Also with hardly any ranks, so that hashes behind the bitmap carry words and phrases."""
    want = brute_phrases([(r.lang, r.text) for r in docs.select("lang", "text").collect()], least, top=top)
    assert len(want) > 15
    assert {tuple(r) for r in collocation.mine(docs, least=least, head=head, top=top).collect()} == want


def test_phrases_odd(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert collocation.mine(none).count() == 0
    one = "a b, A B. a  b\tc\x0bx" + " y" * 300
    d = spark.createDataFrame([(None, one), ("und", one), ("en", None), ("en", "")], "lang string, text string")
    assert {tuple(r) for r in collocation.mine(d, least=2).collect()} == brute_phrases([(None, one)] * 2, 2)


def test_tiles():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 3000, (2, 300_000)) ** 2 // 3000
    b[::1000] += collocation.HASHED
    x, y, c = collocation.tile_counts(a, b, 2500)
    assert dict(zip(zip(x.tolist(), y.tolist()), c.tolist())) == Counter(zip(a.tolist(), b.tolist())) and len(x) == len(set(zip(x, y)))
    assert all(len(p) == 0 for p in collocation.tile_counts(a[:0], b[:0], 2500))


def test_shared_hash_is_seen(spark):
    d = spark.createDataFrame([(1, 200), (1, 3), (2, 300), (3, 1), (3, 2)], "h long, c long")
    assert collocation._clash(d, 100) and not collocation._clash(d.filter("h > 1"), 100)


# ---- 12 -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_encoder_is_the_library(library):
    v = sentencepiece_bpe.Vocabulary(open(MODEL, "rb").read())
    e, d = sentencepiece_bpe.Encoder(v), sentencepiece_bpe.Decoder(open(MODEL, "rb").read())
    rng = random.Random(3)
    pool = [p.replace("▁", " ") for p in v.ids]
    kinds = [lambda: "".join(rng.choices(pool, k=rng.randint(0, 12))), lambda: "".join(rng.choices("aab ▁\n0é日‍<>x\x00", k=rng.randint(0, 25))),
             lambda: "".join(rng.choices("esth inaoer", k=rng.randint(0, 60))), lambda: " " * rng.randint(0, 40) + chr(rng.choice([0x300, 0x1F600, 0xFFFD, 0x85, 0x10FFFF, 0xE000]))]
    for i in range(8000):
        text = kinds[i % 4]()
        ids = library.encode(text)
        assert e.encode(text) == ids, repr(text)
        assert d.decode(ids) == library.decode(ids), repr(text)
        v.cut, cut = None, v.cut  # the whole text at once, without cuts
        assert sentencepiece_bpe.Encoder(v).encode(text) == ids if i % 10 == 0 else True
        v.cut = cut
    for _ in range(4000):  # any ids, also those no text encodes to
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(0, 3), 28705, 259]) for _ in range(rng.randint(0, 8))]
        assert d.decode(ids) == library.decode(ids), ids


def test_backtracking():
    """Vocabularies in which the longest piece often leads into a dead end, against merging by score."""
    class Tiny(sentencepiece_bpe.Vocabulary):
        def __init__(self, pieces):
            import ahocorasick

            self.ids = {p: i for i, p in enumerate(pieces)}
            self.score = {p: -float(i) for i, p in enumerate(pieces)}
            self.automaton = ahocorasick.Automaton()
            for p in pieces:
                self.automaton.add_word(p, (1 - len(p), p))
            self.automaton.make_automaton()
            self._shorter = {p: next(p[:n] for n in range(len(p) - 1, 0, -1) if n == 1 or p[:n] in self.ids) for p in pieces if len(p) > 1}
            self._histories, self._apart = {}, {}

    def merged(v, text):
        s = list(text)
        while True:
            best = max(((v.score[a + b], -i) for i, (a, b) in enumerate(zip(s, s[1:])) if a + b in v.score), default=None)
            if best is None:
                return s
            s[-best[1]:2 - best[1]] = [s[-best[1]] + s[1 - best[1]]]

    rng = random.Random(5)
    for _ in range(300):
        pieces = list(dict.fromkeys("".join(rng.choices("abc", k=rng.choice([2, 2, 3, 3, 4, 5]))) for _ in range(rng.randint(3, 14))))
        v = Tiny(pieces)  # in any order, so many pieces cannot be made by their own merges
        for _ in range(20):
            text = "".join(rng.choices("abc", k=rng.randint(1, 30)))
            assert v.pieces(text) == merged(v, text), (pieces, text)


def test_encode_tables(spark, docs, library):
    got = sentencepiece_bpe.decode(sentencepiece_bpe.encode(docs, MODEL, carry=("doc_id", "text")), MODEL).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids)
    clash = docs.select(docs.text.alias("ids"), docs.doc_id.alias("decoded"))
    assert sentencepiece_bpe.encode(clash, MODEL, text="ids", carry=()).count() == len(got)
    assert sentencepiece_bpe.encode(spark.createDataFrame([], SCHEMA), MODEL).count() == 0
    long = "eins zwei " * 100_000 + "x" * 100_000
    out = sentencepiece_bpe.encode(spark.createDataFrame([(1, long)], "doc_id long, text string"), MODEL).first()
    assert out.ids == library.encode(long)


def test_query_digests(spark, library):
    import hashlib

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in op12_sentencepiece(spark, SF_SMALL).collect():
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# ---- 13 -----------------------------------------------------------------------

def check_whitening(x, out, k=32):
    """Rows of whiten() (one id for each row of x) against an eigen decomposition."""
    n, d = x.shape
    s = x.sum(axis=0)
    c = (n * x - s) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = int((values[:k] > 1e-13 * values[0]).sum())
    assert len(out) == n * rank and {r.component for r in out} == set(range(1, rank + 1))
    y = np.zeros((n, rank))
    for r in out:
        y[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == int(((n * x[r.vec_id] - s) ** 2).sum())
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9)
        assert r.identity_error < 1e-9
    assert np.abs(y.T @ y / n - np.eye(rank)).max() < 1e-9
    gaps = np.diff(values[:rank + 1]) if rank < d else np.append(np.diff(values), -values[-1])
    for i in range(rank):  # where an eigenvalue stands alone, its component does too
        if min(abs(gaps[i]), abs(gaps[i - 1]) if i else np.inf) > 1e-3 * values[0]:
            ref = c @ vectors[:, i] / np.sqrt(values[i])
            assert np.abs(ref * np.sign(ref @ y[:, i]) - y[:, i]).max() < 1e-8


@pytest.mark.parametrize("kind", ["plain", "repeated", "low_rank", "few"])
def test_whitening(spark, kind):
    rng = np.random.default_rng(2)
    e = rng.standard_normal((400, 12)) * np.linspace(3, 0.2, 12)
    if kind == "repeated":  # an orthogonal design: all eigenvalues of a group are the same
        e = np.vstack([s * np.eye(12) * (4 if j else 2) for s in (1, -1) for j in (0, 1)] * 5)
    elif kind == "low_rank":
        e = np.hstack([e[:, :3], np.zeros((400, 2)), 2 * np.floor(64 * e[:, :1]) / 64])
    elif kind == "few":
        e = e[:5]
    x = np.floor(64 * e).astype(np.int64) + 1000000
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(e)], "vec_id long, embedding array<double>").repartition(3)
    check_whitening(x, whitening.whiten(df, components=8).collect(), 8)


def test_whitening_odd(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0, 0.5], [0.0, -1.0, 3.0], [4.0, 0.0, 0.0], [2.0, 2.0, -9.0], [2.0, 2.0, -9.0]]
    bad = [None, [], [1.0, None, 2.0], [nan, 1.0, 2.0], [inf, 0.0, 0.0], [0.0, -inf, 0.0], [1.0, 2.0], [5.0]]
    d = spark.createDataFrame([(i, v, 1, "c") for i, v in enumerate(good + bad)], "vec_id long, embedding array<float>, n int, component string")
    x = np.floor(64 * np.array(good)).astype(np.int64) + 1000000
    check_whitening(x, whitening.whiten(d).collect())
    no_ids = whitening.whiten(d.withColumn("vec_id", d.vec_id * None)).collect()
    assert len(no_ids) == 15 and all(r.vec_id is None for r in no_ids)
    assert whitening.whiten(d.limit(0)).count() == 0 and whitening.whiten(d.filter("vec_id IN (3, 4, 6)")).count() == 0
    wide = whitening.Centre(3 * 10 ** 9, [3 * 10 ** 15 + 5, 3 * 10 ** 15])
    x = np.array([[10 ** 6, 10 ** 6], [10 ** 6 + 9, 10 ** 6]])
    want = [sum((wide.n * int(v) - s) ** 2 for v, s in zip(r, (3 * 10 ** 15 + 5, 3 * 10 ** 15))) for r in x]
    assert wide.deviations(x.tobytes()) == [w if w < 2 ** 63 else None for w in want]


def test_cells_and_packing():
    rng = np.random.default_rng(2)
    for head in (1, 5, 40, 1 << 16):
        cells = collocation.Cells(head)
        a, b = rng.integers(0, cells.wide, 5000), rng.integers(0, head, 5000)
        number = cells.number(a, b)
        assert number.min() >= 0 and number.max() < 1 << cells.bits
        x, y = cells.pair(number)
        assert (x == a).all() and (y == b).all()
    columns = [rng.integers(0, 1 << bits, 700) for bits in (1, 9, 40, 62)]
    widths, data = collocation.packed(columns)
    assert widths == [1, 2, 5, 8]
    assert all((x == y).all() for x, y in zip(columns, collocation.unpacked(data, 700, widths)))


@pytest.mark.parametrize("head", [5, 1 << 16])
def test_pairs_travel_packed_and_infrequent_ones_are_not_written(spark, monkeypatch, head):
    """All distinct pairs of a run as blobs of a few bytes a pair; only frequent ones are stored, and a phrase
    whose last words are not frequent is not counted at all."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 300, 400)) + " k l m" * (i % 2) + " l m n" * (i % 3 == 0) for i in range(60)]
    written = {}

    def stored(df, name="step"):
        written[name] = df.collect()
        return spark.createDataFrame(written[name], df.schema)

    monkeypatch.setattr(collocation, "stored", stored)
    d = spark.createDataFrame([("en", t) for t in texts], "lang string, text string").coalesce(2)
    assert {tuple(r) for r in collocation.mine(d, least=20, head=head).collect()} == brute_phrases([("en", t) for t in texts], 20)
    assert all(r.c >= 20 for name, rows_ in written.items() if name.startswith("pairs") for r in rows_)
    if head > 300:
        cells = collocation.Cells(head)
        a, b = rng.integers(0, 300, (2, 50_000))
        pair = np.unique(cells.number(a, b))
        assert len(collocation.packed([np.diff(pair, prepend=0), np.ones(len(pair), np.int64)])[1]) < 5 * len(pair)


def test_shared_hash_of_pairs_is_seen(monkeypatch):
    cells = collocation.Cells(2)
    monkeypatch.setattr(collocation, "pair_hash", lambda a, b, seed: np.zeros(len(a), np.int64) | collocation.HASHED)
    far = [(3000, 1, 70), (3000, 2, 5)]
    widths, data = collocation.packed([np.diff([x[0] for x in far], prepend=0), *(np.array([x[i] for x in far]) for i in (1, 2))])
    table = collocation.pa.table({"part": [0], "far": [True], "n": [2], "widths": [widths], "data": [data]})
    out = collocation._add_pairs(cells, 50, 0)(table).to_pylist()
    assert [(r["a"], r["b"], r["c"], r["clash"]) for r in out] == [(3000, 1, 70, True)]
    assert not any(r["clash"] for r in collocation._add_pairs(cells, 500, 0)(table).to_pylist())
