"""Fitting on all training texts; candidate pairs that come once."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import lm_score
from starloom.llm.near_dedup import crossed
from test_llm_operators import remainder


def lm_texts(n=420):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    return [" ".join(vocabulary[int(rng.random() ** 2 * 300)] for _ in range(rng.randint(1, 25))) for _ in range(n)]


def test_lm_weights_see_all_training_tokens(spark):
    words = [("the", 900), ("of", 40), ("once", 1), ("four", 4), ("", 400)]
    counts = spark.createDataFrame([(w.encode(), c) for w, c in words] + [(b"heldout", 0)], "token binary, c long").repartition(3)
    model = lm_score.learn(counts)
    first = lm_score.Mixer(model.logit, model.level)
    assert (model.seen - first.seen).sum() == pytest.approx(sum(8 * (len(w) + 1) * c for w, c in words))
    assert (model.weights != first.weights).any()
    assert (lm_score.learn(counts.filter("c = 0")).weights == first.weights).all()


def test_lm_scores_do_not_depend_on_who_holds_a_text(spark):
    """Training texts change places, so any choice of training documents by their ids would fit other weights."""
    texts = lm_texts()
    held = [i for i in range(len(texts)) if remainder(i, 7) == 2]
    train = [i for i in range(len(texts)) if remainder(i, 7) != 2]
    assert len(train) > 300
    dealt = dict(zip(train, random.Random(1).sample(train, len(train))))
    scores = []
    for place in ({}, dealt):
        d = spark.createDataFrame([(i, texts[place.get(i, i)]) for i in range(len(texts))], "doc_id long, text string").repartition(3)
        got = {r.doc_id: r.score for r in lm_score.score_texts(d).collect()}
        scores.append([got[i] for i in held])
    assert scores[0] == pytest.approx(scores[1], rel=1e-6)


def test_lm_shared_beginnings_are_worked_off_once(monkeypatch):
    """Sums and scores as from every token alone, over fewer bytes than the tokens have."""
    rng = random.Random(3)
    tokens = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 9))).encode() for _ in range(900)} | {b"", "caf\u00e9".encode()})
    counts = [rng.choice([1, 2, 3, 4, 5, 40]) for _ in tokens]
    data, starts = lm_score.flat(tokens)
    first, of = lm_score.beginnings(data, starts)
    whole = [t[:i] for t in (t + b" " for t in tokens) for i in range(1, len(t) + 1)]
    assert len(first) == len(set(whole)) < len(data) / 2
    assert [whole[i] for i in first[of]] == whole

    def summed(runs):
        n, ones = np.zeros(lm_score.BASES[-1], np.float32), np.zeros(lm_score.BASES[-1], np.float32)
        for run in runs:
            for out in lm_score._bit_counts([run]):
                n[out.column(0).to_numpy()] += out.column(1).to_numpy()
                ones[out.column(0).to_numpy()] += out.column(2).to_numpy()
        model = lm_score.Mixer(lm_score.logits(n, ones), lm_score.levels(n))
        tables = SimpleNamespace(value=(n + 1j * ones).astype(np.complex64))
        sums = []
        for refine in (False, True):
            total = np.zeros(256 * lm_score.LEVELS * 42 + 1)
            for run in runs:
                for out in lm_score._fit_sums(tables, SimpleNamespace(value=model.weights), refine)([run]):
                    total[out.column(0).to_numpy()] += out.column(1).to_numpy()
            sums.append(total)
        return n, ones, *sums, np.concatenate([model.score(r.column(0).to_pylist()) for r in runs])

    batch = pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary()), pa.array(counts, pa.int64())], names=["token", "c"])
    alone = summed([batch.slice(i, 1) for i in range(len(tokens))][::7])
    some = pa.Table.from_batches([batch.slice(i, 1) for i in range(0, len(tokens), 7)]).combine_chunks().to_batches()[0]
    for x, y in zip(alone, summed([some])):
        assert y == pytest.approx(x, rel=1e-9, abs=1e-9)
    seen = []
    contexts = lm_score.slots
    monkeypatch.setattr(lm_score, "slots", lambda c, node, k: seen.append(len(c)) or contexts(c, node, k))
    lm_score.Mixer(*np.zeros((2, lm_score.BASES[-1]))).score(tokens)
    assert max(seen) == len(first)


def test_pairs_of_several_nodes_are_crossed_once(spark):
    same, far = [0] * 40, [-1] * 40
    members = [(1, 100, 1), (2, 100, 2), (3, 100, 3), (4, 100, 4)]  # rep, size, component; 1 is every node's smallest
    rows = [(node, rep, size, comp, 1, 1, far if rep == 4 else same, [7, 8, 9]) for node in (9, 7, 8) for rep, size, comp in members]
    placed = spark.createDataFrame(rows, "node long, rep long, size long, comp long, hub long, hub_comp long, sketch array<long>, shared array<long>")
    plan = crossed(placed, 75, 40)
    assert [tuple(r) for r in plan.collect()] == [(3, 2)]
    joined = placed.sparkSession.createDataFrame(rows[4:], placed.schema)  # one node fewer than listed: the first shared one is gone
    assert crossed(joined.filter("node <> 7"), 75, 40).count() == 0
    assert sorted(tuple(r) for r in crossed(placed, 75).collect()) == [(3, 2), (4, 2), (4, 3)]
