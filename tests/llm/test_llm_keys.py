"""Rows without an id, different texts under one id, and components of graphs larger than a block."""

import random

import numpy as np
import pytest

import brute
import corpus_pipeline
from conftest import SF_SMALL
from starloom.llm.graph import connected_components, forest
from starloom.llm.line_dedup import dedup_lines
from starloom.llm.near_dedup import near_duplicates


def words(n, seed):
    return [f"w{seed}x{i}" for i in range(n)]


@pytest.mark.parametrize("block", [0, 12, 1 << 20])
def test_components(spark, block):
    """Paths, stars, a cycle and repeated edges; ended in one task at once, midway or never."""
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 20)] + [(200, 201), (201, 202), (202, 200), (7, 7), (-9, 2**62)]
    edges += [(300 + rng.randrange(30), 300 + rng.randrange(30)) for _ in range(25)] + edges[:5]
    rng.shuffle(edges)
    edges = [e if rng.random() < 0.5 else e[::-1] for e in edges]
    own = [e for e in edges if e[0] != e[1]]
    want = brute.components(sorted({x for e in own for x in e}), own)
    got = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(3), block=block).collect()
    assert len(got) == len({r.id for r in got})
    assert {r.id: r.component for r in got} == want


def test_components_without_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_of_a_long_path():
    order = np.random.default_rng(3).permutation(50_000)
    u, v = np.maximum(order[1:], order[:-1]), np.minimum(order[1:], order[:-1])
    ids, label = forest(u, v)
    assert len(ids) == 49_999 and not label.any()


def test_near_copies_without_id(spark):
    """Near copies that all lack an id are one component, of which one text is kept."""
    w = words(61, 1)
    texts = [" ".join(w[:60]), " ".join(w), " ".join(w[:60] + ["end"]), " ".join(words(40, 2))]
    rows = [(None, t) for t in texts] + [(None, texts[0])]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.component_id is None for r in got)
    kept = sorted(r.n_shingles for r in got if r.kept)
    assert kept[0] == 36 and len(set(kept[1:])) == 1  # the other text, and one text of the three (with its repeated row)
    assert len(kept) <= 3


def test_near_copies_take_the_smallest_id(spark):
    """One id names the component of its near copies without an id."""
    w = words(61, 3)
    got = near_duplicates(spark.createDataFrame([(None, " ".join(w)), (8, " ".join(w[:60])), (None, " ".join(w[1:]))], "doc_id long, text string")).collect()
    assert [r.component_id for r in got] == [8, 8, 8]
    assert [r.kept for r in got if r.doc_id is None] == [False, False] and [r.kept for r in got if r.doc_id == 8] == [True]


def test_texts_of_one_id(spark):
    """Different texts under one id are documents of their own, each with its own links."""
    a, b = words(60, 4), words(60, 5)
    rows = [(2, " ".join(a)), (2, " ".join(b)), (1, " ".join(a + ["more"])), (5, " ".join(b + ["more"])), (9, " ".join(words(50, 6)))]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == [
        (1, 57, 1, True), (2, 56, 1, False), (2, 56, 2, True), (5, 57, 2, False), (9, 46, 9, True)]


def test_lines_of_one_id(spark):
    """A line goes from the text of an id that holds it, not from the id's other texts."""
    rows = [(1, "a\nb\nc"), (2, "a\nb\nx"), (2, "p\nq\nr"), (2, "p\nq\nr"), (2, None), (3, "p\nq\nz")]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(
        [(1, "a\nb\nc"), (2, "x"), (2, "p\nq\nr"), (2, "p\nq\nr"), (2, None), (3, "z")], key=str)


def test_pipeline_keeps_texts_of_one_id(spark):
    """Both texts of an id stay unless they are near copies; repeated rows stay once."""
    a, b = " ".join(words(60, 7)), " ".join(words(60, 8))
    rows = [(1, a + " more"), (2, a), (2, b), (2, b), (3, b + " more"), (4, None), (4, ""), (4, "")]
    d = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_dedup(spark, d.repartition(3).cache(), SF_SMALL).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(1, a + " more"), (2, b), (4, None), (4, "")], key=str)
