"""Every operator against a brute-force version, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import brute
from starloom.llm import langid, lm_score, pii, quality
from starloom.llm.decontamination import find_leaks
from starloom.llm.line_dedup import dedup_lines
from starloom.llm.mixing import mix_sources
from starloom.llm.near_dedup import near_duplicates
from starloom.llm.substring_dedup import dedup_substrings
from starloom.llm.vector_dedup import link_vectors

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _d string, id string, hash string, key long, n_lines string, _copies int, c int"
SYLLABLES = {"en": ["the", "ing", "on", "er", "an", "tion", "wh"], "fr": ["é", "eau", "ai", "ou", "ê", "è", "que"], "de": ["ung", "sch", "ä", "ch", "ei", "ß", "ver"]}


def words(rng, n, lang="en"):
    return ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n)]


def rows():
    """Documents with exact and near copies, shared passages and lines, and every odd case."""
    rng = random.Random(7)
    out = []
    passage = " ".join(words(rng, 70))
    lines = [" ".join(words(rng, 8)) for _ in range(3)]
    for i in range(60):
        lang = ("en", "fr", "de")[i % 3]
        body = [" ".join(words(rng, rng.randint(5, 12), lang)) for _ in range(rng.randint(3, 12))]
        if i % 7 == 0:
            body[1:1] = lines
        if i % 5 == 0:
            body.append(passage)
        out.append([i, "\n".join(body), lang, f"s{i % 4}" if i % 9 else None])
    for i in range(60, 75):  # near copies and exact copies
        text = out[i - 60][1]
        if i % 2:
            w = text.split(" ")
            w[len(w) // 2] = "changed"
            text = " ".join(w)
        out.append([i, text, "en", "s1"])
    odd = [None, "", " \n\t ", "one", "One TWO", "12 34 !!", "x" * 30000, "\n".join(["same line here"] * 50), "a b c d\x00 " * 400, "ab" * 150, "ÄÖ ßé", "日本語 テキスト"]
    for i, t in enumerate(odd, 75):
        out.append([i, t, None if i % 2 else "en", "s2"])
    out.append([None, out[3][1], None, None])
    out.append([None, None, None, None])
    out.append(list(out[10]))  # repeated rows
    out.append(list(out[10]))
    return [(*r, len(r[1] or ""), "d", "x", "h", 5, "n", 1, 2) for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def keyed(df):
    return Counter(tuple(r) for r in df.collect())


def remainder(doc_id, m):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % m


# ---- 1 ------------------------------------------------------------------------

def test_decontamination(spark, docs, empty):
    rng = random.Random(3)
    items = [(i, " ".join(words(rng, n)) + ". " + " ".join(words(rng, m)) + ".") for i, (n, m) in enumerate([(12, 4), (30, 9), (40, 15), (150, 60)])]
    filler = [" ".join(words(rng, 300)) for _ in range(6)]
    planted = [(0, filler[0] + " " + items[0][1].upper() + " " + filler[1]), (1, items[1][1].replace(" ", "\n")), (2, filler[2]), (3, items[2][1] + filler[3] + items[3][1]),
               (4, " ".join(items[1][1].split()[:20])), (5, None), (6, ""), (None, items[0][1])]
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, "!!"), (None, "null id")], "item_id long, text string")
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in planted], "doc_id long, text string, items string, _c0 int")
    want = {(0, (0,)), (1, (1,)), (2, ()), (3, (2, 3)), (4, ()), (5, ()), (6, ()), (None, (0,))}
    for block in (8 << 20, 200):  # one block of items, and one for each
        got = {(r.doc_id, tuple(r["items"])) for r in find_leaks(d, bench, block_bytes=block).collect()}
        assert got == want
    assert find_leaks(empty, bench).count() == 0
    assert {len(r["items"]) for r in find_leaks(d, bench.limit(0)).collect()} == {0}


# ---- 2 ------------------------------------------------------------------------

def test_substring_dedup(docs, empty):
    want = Counter(brute.substring_dedup([(r[0], r[1]) for r in rows()], 100))
    for options in ({}, {"hot": 1, "shard_bytes": 2000, "budget": 5000, "in_memory": 50}):
        assert keyed(dedup_substrings(docs, 100, **options)) == want
    assert dedup_substrings(empty, 200).count() == 0


def test_induced_sort():
    from starloom.llm.induced_sort import visit_suffixes

    rng = np.random.default_rng(1)
    for trial in range(60):
        strings = [bytes(rng.integers(97, 97 + rng.integers(2, 4), rng.integers(1, 40)).astype(np.uint8)) for _ in range(rng.integers(1, 9))]
        strings += [strings[0][1:] + b"a", b"aaaaaaaa"]
        text = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8)
        places, suffixes = 0, []
        for i, s in enumerate(strings):
            suffixes += [(s[j:], i, places + j) for j in range(len(s))]
            places += len(s) + 1
        suffixes.sort()
        for options in ({}, {"in_memory": 4, "budget": 200}):  # in memory; recursive and spilled
            pos, lcp = [], []
            visit_suffixes(text, lambda p, c: (pos.append(p), lcp.append(c)), **options)
            assert np.concatenate(pos)[::-1].tolist() == [s[2] for s in suffixes]
            common = [next((k for k, (x, y) in enumerate(zip(a[0], b[0])) if x != y), min(len(a[0]), len(b[0]))) for a, b in zip(suffixes, suffixes[1:])]
            assert np.concatenate(lcp)[1:][::-1].tolist() == common


# ---- 3 ------------------------------------------------------------------------

def test_near_dedup(docs, empty):
    own = [r for r in rows() if r[0] is not None]
    want = brute.near_components([(r[0], r[1]) for r in own])
    for options in ({}, {"leaf": 1, "depth": 2}):  # leaf 1: every mixed node goes on to the deep trees
        got = near_duplicates(docs, **options).collect()
        assert len(got) == len(rows())
        for r in got:
            if r.doc_id is not None:
                assert (r.n_shingles, r.component_id) == want[r.doc_id]
                assert r.kept == (r.doc_id == r.component_id)
        assert sorted((r.component_id, r.kept) for r in got if r.doc_id is None and r.n_shingles) == [(want[3][1], False)]
    assert near_duplicates(empty).count() == 0


# ---- 4 ------------------------------------------------------------------------

def test_pii_very_long_numbers():
    """Parts of an address with more digits than Python reads at once, zeros before them or not."""
    assert pii.base_spans("0" * 4301 + ".1.1.1") == [(1, 0, 4307)]
    assert pii.base_spans("0" * 9000 + "256.1.1.1 " + "9" * 9000 + ".1.1.1") == []


def test_pii_base_spans():
    text = "mail a.b@c.d.example or x@y, 10.0.0.1 999.1.1.1 1.2.3.4.5.6.7.8, 4111 1111 1111 1111 4111-1111-1111-1112 +49 (30) 1234-5678 +1 23 é a@b.cc@d.ee"
    want = [("email", "a.b@c.d.example"), ("email", "a@b.cc"), ("ip", "10.0.0.1"), ("ip", "1.2.3.4"), ("ip", "5.6.7.8"), ("phone", "+49 (30) 1234-5678")]
    got = [(pii.KINDS[k], text[a:b]) for k, a, b in pii.base_spans(text)]
    assert [g for g in got if g[0] != "card"] == want
    assert [g for g in got if g[0] == "card"] == []  # the two cards are one run of 32 digits, which fails
    assert [(k, a) for k, a, b in pii.base_spans("4111 1111 1111 1111,x")] == [(2, 0)]
    rng = random.Random(5)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(500):  # the faster forms equal the plain patterns
        s = "".join(rng.choices("a1.@- 9+", k=40))
        assert [(a, b) for k, a, b in pii.base_spans(s) if k == 0] == [m.span() for m in email.finditer(s)]
        assert [(a, b) for k, a, b in pii.base_spans(s) if k == 1] == [m.span() for m in ip.finditer(s) if all(int(x) <= 255 for x in m[0].split("."))]


def test_pii(spark, empty):
    rng = np.random.default_rng(31)
    long = "words " * 20000
    base = "é mail jo.doe@mail.example now. " + long + "10.1.2.3 " + long
    generated = [(*pii._generated(rng), i) for i in range(200)]
    d = spark.createDataFrame([(0, base, 1), (1, None, 1), (2, "", 1), (3, "no data here", 1), (None, "a@b.cd", 1), (0, base, 1)]
                              + [(100 + i, f"the words of {s} and more words", 1) for _, s, i in generated], "doc_id long, text string, spans int")
    got = {}
    for r in pii.find_pii(d, train=d.filter("doc_id < 100")).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[0]) == 2 and got[0][0] == got[0][1]
    r = got[0][0]
    spans = pii.base_spans(base)
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 0, 0)
    assert r.base_sha256 == hashlib.sha256(pii.joined(spans).encode()).hexdigest()
    assert set(pii.joined(spans).split(",")) <= set(r.spans.split(","))
    for i in (1, 2, 3):
        assert got[i][0].spans == "" and got[i][0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[None][0].spans == "email:0:6"
    right = sum(got[100 + i][0].spans == f"{pii.KINDS[k]}:13:{13 + len(s)}" for k, s, i in generated)
    assert right >= 0.8 * len(generated)  # held-out notations, regular or not
    assert pii.find_pii(empty).count() == 0


def test_tagger_gradients():
    from starloom.llm.tagger import Tagger

    t, rng = Tagger(7, 3, 4, 5), np.random.default_rng(0)
    codes, tags = rng.integers(0, 7, (4, 6)), rng.integers(0, 3, (4, 6))
    _, g = t.gradients(codes, tags)
    for k, p in t.p.items():
        at = tuple(rng.integers(0, n) for n in p.shape)
        old = p[at]
        p[at] = old + 1e-3
        up, _ = t.gradients(codes, tags)
        p[at] = old - 1e-3
        down, _ = t.gradients(codes, tags)
        p[at] = old
        assert abs((up - down) / 2e-3 - g[k][at]) < 1e-3


# ---- 5 ------------------------------------------------------------------------

def test_vector_dedup(spark):
    rng = np.random.default_rng(5)
    vectors, at = [], 0
    for group in range(120):
        centre = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 5))):
            vectors.append((at, [float(x) for x in centre + rng.standard_normal(16) * 0.12], int(group % 3)))
            at += 1
    vectors += [(at, vectors[0][1], 0), (at + 1, [2 * x for x in vectors[0][1]], 0), (at + 2, vectors[0][1], None), (at + 3, None, 0), (at + 4, [0.0] * 16, 0), (at + 5, [], 0),
                (at + 6, [float("nan")] * 16, 0), (at + 7, [None] * 16, 0), (at + 8, vectors[0][1][:8], 0), (at + 9, vectors[0][1][:8], 0), (at + 10, [1e300] * 16, 1), (at + 11, [1e-300] * 16, 1)]
    want = brute.vector_links([v for v in vectors if v[0] < at + 10])
    want[at + 10] = want[at + 11] = (1, at + 10)
    d = spark.createDataFrame([(*v, "z") for v in vectors], "vec_id long, embedding array<double>, label int, cell string")
    got = {r.vec_id: r for r in link_vectors(d).collect()}
    assert set(got) == set(want)
    links = sum(w[0] for w in want.values())
    assert 0.95 * links <= sum(r.n_links for r in got.values()) <= links
    assert sum((r.n_links, r.component_id) == want[i] for i, r in got.items()) >= 0.95 * len(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert link_vectors(d.limit(0)).count() == 0


def test_vector_links_count_for_both_sides(spark):
    """Pairs at the threshold, few visits: a link that one side's visits find is counted for both."""
    rng = np.random.default_rng(11)
    vectors = []
    for pair in range(800):
        x, y = rng.standard_normal((2, 16))
        x /= np.linalg.norm(x)
        y -= (x @ y) * x
        y = 0.94 * x + np.sqrt(1 - 0.94 ** 2) * y / np.linalg.norm(y)
        vectors += [(2 * pair, x.tolist(), 0), (2 * pair + 1, y.tolist(), 0)]
    vectors += [(1600 + i, vectors[2 * i + 1][1], 0) for i in range(200)]  # copies: each counts
    d = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")
    want = brute.vector_links(vectors)
    whole = Counter(c for _, c in want.values())
    assert all(n == whole[c] - 1 for n, c in want.values())
    got = link_vectors(d, recall=0.8).collect()
    size = Counter(r.component_id for r in got)
    found = [r for r in got if size[r.component_id] == whole[r.component_id] > 1]
    assert len(found) > 1000 and [r for r in found if r.n_links != want[r.vec_id][0]] == []


def test_multi_sequence_order():
    from starloom.llm.vector_dedup import Grid, _distances, _halves

    x = np.random.default_rng(2).standard_normal((300, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    grid = Grid(x, 8, 0.93, 0.99)
    d1, d2 = (_distances(h, b) for h, b in zip(_halves(x), grid.books))
    total = (d1[:, :, None] + d2[:, None, :]).reshape(len(x), -1)
    mine = np.take_along_axis(total, grid.nearest(x), 1)
    assert np.allclose(mine, np.sort(total, axis=1)[:, :grid.visits])


# ---- 6 ------------------------------------------------------------------------

def test_quality(spark, docs, empty):
    rng = random.Random(9)
    good = [(i, " ".join(words(rng, 60)).capitalize() + ".") for i in range(200)]
    bad = [(200 + i, "!! ".join(words(rng, 40)).upper() if i % 2 else " ".join([w for w in words(rng, 8) for _ in range(9)])) for i in range(200)]
    d = spark.createDataFrame([(*x, 1.0) for x in good + bad] + [(500, None, 1.0), (501, "", 1.0), (None, "x", 1.0), (0, good[0][1], 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i < 200), "q") for i in range(0, 400)] + [(None, 1, "q"), (500, None, "q"), (0, 1, "q")], "doc_id long, quality int, predicted string")
    out = quality.score_quality(d, labels).collect()
    assert len(out) == 404 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) for r in out)
    held = [r for r in out if r.held_out and r.doc_id < 400]
    assert sum(r.predicted == int(r.doc_id < 200) for r in held) >= 0.97 * len(held)
    assert {r.score for r in quality.score_quality(d, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(empty, labels).count() == 0


# ---- 7 ------------------------------------------------------------------------

def test_lm_score(docs, empty):
    texts = [(r[0], [*(r[1] or "").encode().lower().split(), b""]) for r in rows()]
    count = Counter()
    for i, ws in texts:
        if remainder(i, 7) != 2:
            count.update(ws)
    n, v = sum(count.values()), len(count)
    want = Counter((i, len(ws), sum(count[w] > 0 for w in ws), round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in texts)
    for options in ({}, {"frequent": 20}):  # all tokens broadcast; most of them joined
        out = lm_score.score_texts(docs, bound=40, **options).collect()
        assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out) == want
        assert {r.train_tokens for r in out} == {n}
        assert all(r.score < 0 and r.held_out == (remainder(r.doc_id, 7) == 2) for r in out)
    assert lm_score.score_texts(empty).count() == 0


def test_mixer_is_a_distribution():
    model = lm_score.Mixer(np.zeros(lm_score.BASES[-1]), np.zeros(lm_score.BASES[-1]))
    model.learn([b"the", b"of", b"the", b"a"] * 200)
    one_byte = [bytes([b]) for b in range(256) if b != lm_score.END]
    # every token of one byte, the end, and (all longer tokens) the mass behind one byte that is not closed
    firsts = 10 ** model.score([b""]) + sum(10 ** (model.score([t])[0]) / 10 ** _close(model, t) for t in one_byte)
    assert abs(firsts[0] - 1) < 1e-6
    assert model.score([b"the"])[0] > model.score([b"qqq"])[0]


def _close(model, token):
    """log10 probability of the closing mark after ``token``."""
    data, starts = lm_score.flat([token])
    hashes, total = lm_score.contexts(data, starts), 0.0
    for node, bit in lm_score.bits_of(data):
        _, _, p, bucket = model.mixed(hashes, node)
        p = model.refined(node, p, bucket)
        total += float(np.log10(np.where(bit == 1, p, 1 - p))[-1])
    return total


# ---- 8 ------------------------------------------------------------------------

def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, rest, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            target.update({s: level * weight[s] for s in open_})
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
        open_ -= full
    return target


def test_mixing(spark, docs, empty):
    source = {}
    for r in rows():
        source[r[3]] = source.get(r[3], 0) + len(brute.WORD.findall(r[1] or ""))
    target = brute_targets(source)
    out = mix_sources(docs).collect()
    assert len(out) == len(rows())
    assert Counter((r.doc_id, r.size) for r in out) == Counter((r[0], len(brute.WORD.findall(r[1] or ""))) for r in rows())
    of = {(s, round(target[s], 6)) for s in source}
    assert {(r.source_size, round(r.target, 6)) for r in out} == {(source[s], t) for s, t in of}
    for s in source:
        taken = sum(r.taken for r in out if (r.source_size, round(r.target, 6)) == (source[s], round(target[s], 6)))
        assert abs(taken - target[s]) <= max(r.size for r in out)
    assert all(r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0) for r in out)
    assert Counter(map(tuple, mix_sources(docs).collect())) == Counter(map(tuple, out))  # reruns agree
    assert mix_sources(empty).count() == 0
    # a rare small source is capped at three times its size
    d = spark.createDataFrame([(i, "w " * 20, "big") for i in range(200)] + [(900 + i, "w " * 5, "tiny") for i in range(3)], "doc_id long, text string, source string")
    got = {r.source_size: (r.target, r.copies) for r in mix_sources(d).collect()}
    assert got[15] == (45.0, 3) and abs(got[4000][0] - (4015 - 45)) < 1e-9


def test_mixing_keeps_probabilities(spark):
    """Over many seeds a document's average number of copies is its probability."""
    d = spark.createDataFrame([(i, "w " * (1 + i % 5), "a" if i % 3 else "b") for i in range(40)], "doc_id long, text string, source string").cache()
    runs = [mix_sources(d, seed=s).collect() for s in range(25)]
    p = {r.doc_id: r.target / r.source_size for r in runs[0]}
    mean = {i: sum(r.copies for run in runs for r in run if r.doc_id == i) / len(runs) for i in p}
    assert abs(np.mean([mean[i] - p[i] for i in p])) < 0.05


# ---- 9 ------------------------------------------------------------------------

def test_language_id(spark, empty):
    rng = random.Random(12)
    texts = [(i, " ".join(words(rng, rng.randint(6, 60), lang)), lang, "x") for i, lang in enumerate(["en", "fr", "de"] * 80)]
    odd = [(900, None, "en", "x"), (901, "", "fr", "x"), (902, "123 !!", None, "x"), (None, "the thing on", "en", "x"), (903, "a" * 5000, None, "x"), (904, "²", None, "x"), texts[0], texts[0]]
    d = spark.createDataFrame(texts + odd, "doc_id long, text string, lang string, lang_pred string")
    out = langid.identify(d, bound=50).collect()
    assert len(out) == len(texts) + len(odd)
    assert all(0 <= r.score <= 1 and r.held_out == (remainder(r.doc_id, 5) == 0) for r in out)
    lang = {t[0]: t[2] for t in texts}
    held = [r for r in out if r.held_out and r.doc_id in lang]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    assert {r.doc_id: r.lang_pred for r in out if r.doc_id in (900, 901, 902, 904)} == {900: "und", 901: "und", 902: "und", 904: "und"}
    kept = langid.keep_identified(d, bound=50)
    assert kept.columns == d.columns
    assert not {900, 901, 902, 904} & {r.doc_id for r in kept.collect()}
    assert {r.lang_pred for r in langid.identify(d.filter("lang IS NULL")).collect()} == {"und"}
    assert langid.identify(empty).count() == 0


def test_forward_sums_all_segmentations():
    vocabulary = ["^", "a", "b", "ab", "^a", "ba", "^ab"]
    prob = np.random.default_rng(0).random((len(vocabulary), 2)) / 10
    value = dict(zip(vocabulary, prob))

    def total(s):
        return np.ones(2) if not s else sum((value[s[:n]] * total(s[n:]) for n in range(1, len(s) + 1) if s[:n] in value), np.zeros(2))

    tokens = ["a", "ab", "abab", "bbaab", "abba"]
    got = langid.word_scores(tokens, langid.Pieces(vocabulary), prob)
    assert np.allclose(got, [np.log(total("^" + w)) for w in tokens])


# ---- 10 -----------------------------------------------------------------------

def brute_lines(data, k):
    runs = {}
    lines = {i: (t or "").split("\n") if t is not None else [] for i, t in data if i is not None}
    blank = re.compile(r"[^\x20\x09-\x0D]")
    for i in sorted(lines):
        for p in range(len(lines[i]) - k + 1):
            run = tuple(lines[i][p:p + k])
            if all(blank.search(x) for x in run):
                runs.setdefault(run, []).append((i, p))
    gone = {}
    for places in runs.values():
        for i, p in sorted(places)[1:]:
            gone.setdefault(i, set()).update(range(p, p + k))
    return {i: "\n".join(x for p, x in enumerate(ls) if p not in gone.get(i, ())) for i, ls in lines.items()}


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_line_dedup(docs, empty, k):
    want = brute_lines([(r[0], r[1]) for r in rows()], k)
    for r in dedup_lines(docs, k).collect():
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.text or "") == want[r.doc_id]
    assert dedup_lines(empty, k).count() == 0
    assert set(dedup_lines(docs, k).columns) == {*docs.columns, "n_removed", "n_runs"}


def test_line_dedup_long_lines(spark):
    """A long line is a run by itself: among other neighbours, between blank lines and as a whole text."""
    long, short = " ".join(f"w{i}" for i in range(50)), "a short line"
    texts = ["first\n" + long + "\n" + short, long, "x\n" + long + "\ny", "p\n\n" + long + "\n\n" + short, short + "\nz", long + " more", None]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed, r.n_runs) for r in dedup_lines(d, long_words=50).collect()}
    assert got == {0: (texts[0], 0, 0), 1: ("", 1, 1), 2: ("x\ny", 1, 1), 3: ("p\n\n\n" + short, 1, 1), 4: (texts[4], 0, 0), 5: (texts[5], 0, 0), 6: (None, 0, 0)}


def test_line_dedup_wide_ids(spark):
    """Ids that differ only above bit 39, the largest ones and negative ones are documents of their own."""
    ids = [-(2 ** 63), -5, 3, 3 + 2 ** 40, 3 + 2 ** 41, 2 ** 63 - 1]
    data = [(i, f"own {n}\nsame one\nsame two\nlast {n}") for n, i in enumerate(ids)]
    d = spark.createDataFrame(data, "doc_id long, text string")
    assert {r.doc_id: r.text for r in dedup_lines(d).collect()} == brute_lines(data, 2)
    assert sum(r.n_removed for r in dedup_lines(d, long_words=2).collect()) == 2 * (len(ids) - 1)


def test_substring_dedup_large_keys(spark, monkeypatch):
    """Own texts around one passage share keys; those that outgrow the bound are never sorted in one task."""
    from pyspark.sql import functions as F

    from starloom.llm import substring_dedup as sd

    rng = random.Random(21)
    passage = "".join(rng.choices("abcdefgh", k=300))
    data = [(i, "".join(rng.choices("ijklmnop", k=150)) + passage[i % 3:] + "".join(rng.choices("ijklmnop", k=150))) for i in range(80)]
    data += [(100, data[0][1]), (101, "z" + passage[40:260]), (102, passage[:150])]
    d = spark.createDataFrame(data, "doc_id long, text string").repartition(3).cache()
    most, contexts = [], sd._contexts

    def watched(length, k, large):
        run = contexts(length, k, large)
        held = d.select("doc_id", F.xxhash64("text").alias("_t"), "text").withColumnRenamed("doc_id", "_d")
        _, wanted = sd.candidates(held, length, 1)
        lists = wanted.groupBy("_d", "_t").agg(F.collect_list("c").alias("cs"))
        rows = held.join(lists, ["_d", "_t"]).select("_d", "_t", "text", "cs").mapInArrow(run, "key long, n long, _d long, _t long, first int, owned int, body binary")
        most.append(max((r[0] for r in rows.groupBy("key").agg(F.sum(F.length("body"))).select("sum(length(body))").collect()), default=0))
        return run

    want = Counter(brute.substring_dedup(data, 200))
    monkeypatch.setattr(sd, "_contexts", watched)
    assert keyed(dedup_substrings(d, 200, hot=1)) == want
    assert keyed(dedup_substrings(d, 200, hot=1, key_bytes=3000)) == want
    assert most[0] > 3000 >= most[1]


def test_quality_sees_words(spark):
    """Texts of one shape whose quality shows in their words alone."""
    rng = random.Random(17)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(240)]
    data = [(i, " ".join(rng.choices(vocabulary[:120] if i % 2 else vocabulary[120:], k=40))) for i in range(400)]
    d = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    held = [r for r in quality.score_quality(d, labels).collect() if r.held_out]
    assert sum(r.predicted == r.doc_id % 2 for r in held) >= 0.95 * len(held)
