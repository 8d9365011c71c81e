"""Language ID by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.
A word's probability is the sum over all its segmentations into pieces, by
the forward algorithm; a text's is the product over its words.  The piece
probabilities are trained by expectation maximisation: expected piece counts
of a word come from the forward and backward sums over its segmentations.

Training uses at most ``bound`` documents of each language (those with the
smallest id hash), which only gives word counts; prediction reads whole texts.
Words repeat, so each task scores a distinct word once and keeps a bounded
cache of scores.

Defined results
* null text or text without a letter: ``und``, score 0.
* words are runs of letters, lower-cased; digits, signs and marks-up say nothing.
* words over ``STRETCH`` letters are scored in stretches of that many letters.
* a letter that no piece holds counts as one rare piece, alike in all languages.
* ties go to the language that sorts first; the score is the posterior
  probability of the predicted language under equal priors.
* nothing to learn from (no labelled row): every text is ``und``.
* rows with null doc_id or lang are never learned from; repeated rows of a
  sampled id are read once each; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded_sample, id_remainder

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
LETTERS = re.compile(r"[^\W\d_]+")
STRETCH = 32
LONGEST = 8  # characters of a piece, word mark included
RARE = 1e-7
CACHE = 200_000
_MUL = np.uint64(0x9E3779B97F4A7C15)
_SIEVE = 21


def read_vocabulary(path: str) -> list[str]:
    """Lower-case pieces of letters of a public sentencepiece vocabulary, '^' for its word mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).replace("▁", "^") for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if re.fullmatch(r"\^?[^\W\d_]*", p) and p == p.lower() and 1 <= len(p) <= LONGEST)


def words_of(text: str) -> list[str]:
    """The letter runs of a text, in stretches; empty if it has no letter."""
    found = LETTERS.findall(text.lower())
    if not any(w.isalpha() for w in found) and not any(c.isalpha() for w in found for c in w):
        return []
    if found and max(map(len, found)) > STRETCH:
        return [w[i:i + STRETCH] for w in found for i in range(0, len(w), STRETCH)]
    return found


def _codes(words: list[str], width: int) -> np.ndarray:
    """Code points of '^word', 0 behind its end."""
    joined = "".join(("^" + w).ljust(width, "\0") for w in words)
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(len(words), width).astype(np.uint64)


class Pieces:
    """The vocabulary as sorted hashes; finds the piece of every substring of many words at once."""

    def __init__(self, pieces: list[str]):
        h = np.zeros(len(pieces), np.uint64)
        for i, p in enumerate(pieces):
            v = np.uint64(0)
            with np.errstate(over="ignore"):
                for c in p:
                    v = (v + np.uint64(ord(c))) * _MUL
                    v ^= v >> np.uint64(29)
            h[i] = v
        self.order = np.argsort(h)
        self.keys = h[self.order]
        self.sieve = np.zeros(1 << _SIEVE, bool)
        self.sieve[self.keys >> np.uint64(64 - _SIEVE)] = True
        self.n = len(pieces)

    def find(self, codes: np.ndarray):
        """Yields (start, length, words that have a piece there, its index)."""
        width = codes.shape[1]
        for start in range(width):
            h = np.zeros(len(codes), np.uint64)
            alive = np.arange(len(codes))
            for length in range(1, min(LONGEST, width - start) + 1):
                c = codes[alive, start + length - 1]
                alive, h, c = (x[c > 0] for x in (alive, h, c))
                if not len(alive):
                    break
                h = (h + c) * _MUL
                h ^= h >> np.uint64(29)
                maybe = np.flatnonzero(self.sieve[h >> np.uint64(64 - _SIEVE)])
                if len(maybe):
                    at = np.minimum(np.searchsorted(self.keys, h[maybe]), self.n - 1)
                    hit = self.keys[at] == h[maybe]
                    yield start, length, alive[maybe[hit]], self.order[at[hit]]


def forward(codes: np.ndarray, pieces: Pieces, prob: np.ndarray, spans=None) -> np.ndarray:
    """alpha[word, position, language]: probability of the word's first ``position`` characters over all segmentations."""
    n, width = codes.shape
    alpha = np.zeros((n, width + 1, prob.shape[1]))
    alpha[:, 0] = 1
    at = 0
    for start, length, rows, piece in (spans if spans is not None else pieces.find(codes)):
        while at < start:
            at += 1
            _rare(alpha, at)
        alpha[rows, start + length] += alpha[rows, start] * prob[piece]
    while at < width:
        at += 1
        _rare(alpha, at)
    return alpha


def _rare(alpha: np.ndarray, at: int) -> None:
    """A character that no segmentation reaches is one rare piece."""
    lost = alpha[:, at].max(axis=1) == 0
    alpha[lost, at] = alpha[lost, at - 1] * RARE


def word_scores(words: list[str], pieces: Pieces, prob: np.ndarray) -> np.ndarray:
    """Natural log probability of every word in every language."""
    out = np.zeros((len(words), prob.shape[1]))
    length = np.array([len(w) for w in words]) + 1
    order = np.argsort(length, kind="stable")
    for a in range(0, len(order), 8192):
        part = order[a:a + 8192]
        codes = _codes([words[i] for i in part], int(length[part].max()))
        alpha = forward(codes, pieces, prob)
        out[part] = np.log(np.maximum(alpha[np.arange(len(part)), length[part]], 1e-300))
    return out


def train(counts: dict[str, dict[str, int]], vocabulary: list[str], rounds: int = 3) -> tuple[list[str], np.ndarray]:
    """(languages, prob[piece, language]) by expectation maximisation over word counts."""
    pieces, langs = Pieces(vocabulary), sorted(counts)
    words = sorted({w for c in counts.values() for w in c})
    weight = np.array([[counts[g].get(w, 0) for g in langs] for w in words], float)
    length = np.array([len(w) + 1 for w in words])
    prob = None
    order = np.argsort(length, kind="stable")
    parts = []
    for a in range(0, len(order), 8192):
        part = order[a:a + 8192]
        codes = _codes([words[i] for i in part], int(length[part].max()))
        parts.append((part, codes, list(pieces.find(codes))))
    for _ in range(rounds + 1):
        expected = np.full((len(vocabulary), len(langs)), 0.01)
        for part, codes, spans in parts:
            if prob is None:  # first: every piece that occurs, once
                for _, _, rows, piece in spans:
                    np.add.at(expected, piece, weight[part[rows]])
                continue
            alpha = forward(codes, pieces, prob, spans)
            beta = np.zeros_like(alpha)
            beta[np.arange(len(part)), length[part]] = 1
            for start, n, rows, piece in sorted(spans, key=lambda s: -s[0]):
                beta[rows, start] += prob[piece] * beta[rows, start + n]
            total = alpha[np.arange(len(part)), length[part]]
            for start, n, rows, piece in spans:
                share = alpha[rows, start] * prob[piece] * beta[rows, start + n] / np.maximum(total[rows], 1e-300)
                np.add.at(expected, piece, share * weight[part[rows]])
        prob = expected / expected.sum(axis=0)
    return langs, prob


def _counted(batches):
    """Word counts of each language of a batch."""
    for batch in batches:
        by: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by.setdefault(lang, Counter()).update(words_of(text or ""))
        rows = [(g, w, n) for g, c in by.items() for w, n in c.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                                          pa.array([r[2] for r in rows], pa.int64())], names=["lang", "word", "n"])


def learn(docs: DataFrame, modulus: int = 5, bound: int = 400, vocabulary: str = VOCABULARY,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """(languages, prob, vocabulary pieces) from at most ``bound`` documents of each language, held-out ids left aside."""
    labelled = docs.filter(F.col(lang_col).isNotNull() & (id_remainder(F.col(id_col), modulus) != 0))
    ids = bounded_sample(labelled.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang")).distinct(), F.col("_id"), bound,
                         within=F.col("_lang")).select("_id").distinct()
    chosen = [r[0] for r in ids.collect()]  # at most bound ids of each language
    rows = (labelled.filter(F.col(id_col).isin(chosen)).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .mapInArrow(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).collect())
    counts: dict[str, dict[str, int]] = {}
    for r in rows:
        counts.setdefault(r["lang"], {})[r["word"]] = r["n"]
    pieces = read_vocabulary(vocabulary)
    langs, prob = train(counts, pieces) if counts else ([], np.zeros((len(pieces), 0)))
    return langs, prob, pieces


def _predicted(model):
    def run(batches):
        langs, prob, vocabulary = model.value
        pieces = Pieces(vocabulary)
        known: dict[str, int] = {}
        scores = np.zeros((CACHE, len(langs)))
        for batch in batches:
            preds, best = [], []
            texts = batch.column(1)
            for a in range(0, len(texts), 500):
                docs = [words_of(t) if t else [] for t in texts.slice(a, 500).to_pylist()]
                fresh = list(set().union(*docs).difference(known)) if langs else []
                if len(known) + len(fresh) > CACHE:
                    known = {}
                    fresh = list(set().union(*docs))
                if len(fresh) > len(scores) - len(known):
                    scores = np.concatenate((scores, np.zeros((len(fresh), len(langs)))))
                if fresh:
                    scores[len(known):len(known) + len(fresh)] = word_scores(fresh, pieces, prob)
                    known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
                for words in docs:
                    if not words or not langs:
                        preds.append("und")
                        best.append(0.0)
                        continue
                    total = scores[[known[w] for w in words]].sum(axis=0)
                    i = int(total.argmax())
                    preds.append(langs[i])
                    best.append(float(1 / np.exp(total - total[i]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(preds, pa.string()), pa.array(best, pa.float64()), *batch.columns[2:]],
                                             names=["doc_id", "lang_pred", "score", *batch.schema.names[2:]])

    return run


def identify(docs: DataFrame, modulus: int = 5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    learned = learn(docs, modulus, id_col=id_col, text_col=text_col, lang_col=lang_col, **options)
    model = docs.sparkSession.sparkContext.broadcast(learned)  # pieces x languages: independent of the number of rows
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _predicted(model), "doc_id long, lang_pred string, score double")
    return out.select("doc_id", F.coalesce(id_remainder(F.col("doc_id"), modulus) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is identified with a score of ``least`` or more."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, **options))
    carried = docs.select(F.col("doc_id"), F.col("text").cast("string"), *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns)])
    schema = ", ".join([f"doc_id {carried.schema[0].dataType.simpleString()}", "lang_pred string", "score double"]
                       + [f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema.fields[2:]])
    out = carried.mapInArrow(_predicted(model), schema).filter((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])
