"""SentencePiece BPE encoding and decoding by backtracking.

A text's BPE encoding is the only sequence of pieces that covers it and in which
every two neighbours stay apart when they are merged anew: a merge across a
border would already happen in the text of the two pieces beside it, because
nothing outside them has crossed into them before.  So no merge queue over the
text is needed:

* an Aho-Corasick automaton over the vocabulary gives the longest piece at every position
  in one pass, and a table leads from each piece to its next shorter prefix piece;
* from the left, the longest piece is tried first; it stays if it is compatible with
  the piece before it (``Vocabulary.apart`` merges the two anew, both merge histories
  side by side, and looks for a merge across the border);
* if no piece fits, the last one is taken back and the position behind it is marked in
  a bitfield, so no position fails twice: the sequence up to a position is unique, hence
  what fails behind it fails whatever comes before.

Merges never cross two characters that stand side by side in no piece, so a text is cut
there first (in practice before the space mark, and around characters that only
stand alone), and the ids of short cuts are kept in a bounded memory of each task.
Characters outside the vocabulary become their UTF-8 bytes' pieces.

Defined results
* null text counts as empty: no ids, and an empty decoded text.
* every text is encoded whole, whatever its length; texts are worked off in runs of about 1 MB,
  and a longer one alone.
* rows are independent: repeated rows give equal rows, null ids stay, an empty table gives an empty
  result, and other columns come along only if named in ``carry``.
* models whose normaliser rewrites characters, or that have user-defined or unused pieces, are an error.
"""

from __future__ import annotations

import re
from itertools import chain
from operator import add

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"  # the mark that stands for a space in pieces
KEPT = 300_000  # cuts whose ids, and pairs whose compatibility, a task remembers
KEPT_CHARS = 48  # longest cut that is remembered
RUN_BYTES = 1 << 20


def _parsed(model: bytes):
    """The model and its piece kinds; an error if the encoder would not do it justice."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto.FromString(model)
    kind = pb.ModelProto.SentencePiece
    norm = proto.normalizer_spec
    if proto.trainer_spec.model_type != pb.TrainerSpec.BPE:
        raise ValueError("not a BPE model")
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or {p.type for p in proto.pieces} & {kind.USER_DEFINED, kind.UNUSED}:
        raise ValueError("models that rewrite characters or have user-defined or unused pieces are not supported")
    return proto, kind


class Decoder:
    """What each id stands for in a text."""

    def __init__(self, model: bytes):
        proto, kind = _parsed(model)
        self.prefix = bool(proto.normalizer_spec.add_dummy_prefix)
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == kind.UNKNOWN)
        self.surface = [p.piece.replace(SPACE, " ").encode() if p.type == kind.NORMAL else b"" for p in proto.pieces]
        self.surface[self.unknown] = proto.trainer_spec.unk_surface.encode()
        byte = {i: int(p.piece[3:5], 16) for i, p in enumerate(proto.pieces) if p.type == kind.BYTE}
        for i, b in byte.items():
            self.surface[i] = bytes([b])
        self.byte_ids = frozenset(byte)
        self.invisible = frozenset(i for i, p in enumerate(proto.pieces) if p.type == kind.CONTROL)

    def decode(self, ids) -> str:
        """The text of ids: spaces for marks (one at the front goes if the model adds one), runs of
        byte pieces as UTF-8 with U+FFFD for each byte that is none, control pieces invisible."""
        surface, out, run, start = self.surface, [], [], True
        if ids and self.invisible.isdisjoint(ids):
            try:  # pieces end between characters, so bytes that are valid in all are valid run by run
                text = b"".join(map(surface.__getitem__, ids)).decode()
            except UnicodeDecodeError:
                pass
            else:
                return text[1:] if self.prefix and text[:1] == " " and ids[0] != self.unknown and ids[0] not in self.byte_ids else text
        for i in chain(ids, (None,)):
            if i is not None and i in self.byte_ids:
                run.append(surface[i])
                continue
            if run:
                out.append(_utf8(b"".join(run)))
                run = []
            if i is None:
                break
            if out and out[-1]:
                start = False
            text = surface[i].decode()
            if start and self.prefix and i != self.unknown and text.startswith(" "):
                text, start = text[1:], False
            out.append(text)
        return "".join(out)


class Vocabulary:
    """Pieces, scores and byte pieces of a model file, and what follows from them."""

    def __init__(self, model: bytes):
        proto, kind = _parsed(model)
        self.prefix = bool(proto.normalizer_spec.add_dummy_prefix)
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kind.NORMAL}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == kind.NORMAL}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == kind.UNKNOWN)
        byte = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kind.BYTE}
        self.bytes = [byte[b] for b in range(256)] if len(byte) == 256 else None

        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if len(piece) > 1:
                self.automaton.add_word(piece, (1 - len(piece), piece))
        self.automaton.make_automaton()
        # the longest piece (or single character) that is a proper prefix
        self._shorter = {p: next(p[:n] for n in range(len(p) - 1, 0, -1) if n == 1 or p[:n] in self.ids) for p in self.ids if len(p) > 1}
        self._histories: dict[str, tuple] = {}
        self._apart: dict[tuple[str, str], bool] = {}

        self.together = together = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        joined = set("".join(together))
        alone = "".join(re.escape(c) for c in sorted({"\n", *(p for p in self.ids if len(p) == 1)} - joined))
        if not any(b == SPACE != a for a, b in together):
            # no piece holds a space mark behind another character
            self.cut = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else ""))
        else:
            self.cut = None

    def history(self, piece: str) -> tuple[list[float], list[str], list[str], bool]:
        """The merges inside a piece in their order: scores, the symbols at its left and right
        edge before each merge and after the last, and whether they end in the piece itself."""
        got = self._histories.get(piece)
        if got is None:
            symbols, scores, left, right = list(piece), [], [], []
            while True:
                left.append(symbols[0])
                right.append(symbols[-1])
                best = max(((self.score[a + b], -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in self.score), default=None)
                if best is None:
                    break
                scores.append(best[0])
                i = -best[1]
                symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
            got = self._histories[piece] = (scores, left, right, len(symbols) == 1)
        return got

    def apart(self, a: str, b: str) -> bool:
        """Whether the merges of a + b end in exactly a and b.

        Both histories run side by side, the better score first and the left one at a
        tie; a merge of the two symbols at the border that comes before what is
        left of both ends the pair."""
        a_scores, _, a_right, _ = self.history(a) if a else ((), (), ("",), True)
        b_scores, b_left, _, whole = self.history(b)
        i = j = 0
        none = float("-inf")
        while True:
            if not whole or not a:  # b's own merges do not make it one piece, or nothing stands before it
                out = whole
                break
            a_next = a_scores[i] if i < len(a_scores) else none
            b_next = b_scores[j] if j < len(b_scores) else none
            across = self.score.get(a_right[i] + b_left[j])
            if across is not None and across > a_next and across >= b_next:
                out = False
                break
            if a_next == b_next == none:
                out = True
                break
            if a_next >= b_next:
                i += 1
            else:
                j += 1
        _make_room(self._apart)
        self._apart[a, b] = out
        return out

    def pieces(self, text: str) -> list[str]:
        """The encoding of a text (spaces already marked) as pieces and characters outside the vocabulary."""
        n = len(text)
        longest = list(text)  # at every position the longest piece, or the character itself
        for end, (back, piece) in self.automaton.iter(text):
            longest[end + back] = piece  # matches come by their end, so the longest is last
        failed, any_failed = bytearray(n // 8 + 1), False
        known, shorter = self._apart, self._shorter
        out: list[str] = []
        before, at = "", 0  # "" is compatible with what follows it as far as that is one piece
        piece = longest[0] if n else None
        while at < n:
            while piece is not None:
                end = at + len(piece)
                if not (any_failed and failed[end >> 3] >> (end & 7) & 1):
                    fits = known.get((before, piece))
                    if fits or (fits is None and self.apart(before, piece)):
                        break
                piece = shorter[piece] if piece in shorter else None
            if piece is not None:
                out.append(piece)
                before, at = piece, end
                piece = longest[at] if at < n else None
            else:
                failed[at >> 3] |= 1 << (at & 7)
                any_failed = True
                last = out.pop()  # the first position cannot fail: an encoding exists
                before = out[-1] if out else ""
                at -= len(last)
                piece = shorter[last] if last in shorter else None
        return out

    def encode_cut(self, cut: str) -> tuple[int, ...]:
        pieces = self.pieces(cut)
        try:
            return tuple(map(self.ids.__getitem__, pieces))
        except KeyError:
            unknown = (self.unknown,)
            return tuple(chain.from_iterable((self.ids[p],) if p in self.ids else (self.bytes[b] for b in p.encode()) if self.bytes else unknown for p in pieces))


def _make_room(memory: dict) -> None:
    """Forgets the latest half of a full memory: what came first is what is frequent."""
    if len(memory) >= KEPT:
        for _ in range(KEPT // 2):
            memory.popitem()


def _utf8(raw: bytes) -> str:
    """UTF-8 with one U+FFFD for every byte that belongs to no character."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[at:at + n].decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


class Encoder(dict):
    """Cut -> ids, with a bounded memory.  A word without marks stands for itself behind a space mark."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.by_word = vocabulary.prefix and vocabulary.cut is not None

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.whole(word if SPACE in word or not self.by_word else SPACE + word)
        if len(word) <= KEPT_CHARS:
            _make_room(self)
            self[word] = ids
        return ids

    def whole(self, cut: str) -> tuple[int, ...]:
        """The ids of a cut, parted further where two characters stand together in no piece."""
        together = self.vocabulary.together
        if together.issuperset(map(add, cut, cut[1:])):
            return self.vocabulary.encode_cut(cut)
        borders = [i for i, pair in enumerate(map(add, cut, cut[1:]), 1) if pair not in together]
        return tuple(chain.from_iterable(map(self.part, [cut[a:b] for a, b in zip([0, *borders], [*borders, len(cut)])])))

    def part(self, part: str) -> tuple[int, ...]:
        """Remembered like words: as the word if it is one, else under a key that no word has."""
        if self.by_word and part[0] == SPACE and SPACE not in part[1:]:
            return self[part[1:]]
        key = None, part
        ids = self.get(key)
        if ids is None:
            ids = self.vocabulary.encode_cut(part)
            if len(part) <= KEPT_CHARS:
                _make_room(self)
                self[key] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if self.by_word and "  " not in text and text[0] != " " and SPACE not in text:
            return list(chain.from_iterable(map(self.__getitem__, text.split(" "))))
        v = self.vocabulary
        marked = (SPACE if v.prefix else "") + text.replace(" ", SPACE)
        return list(chain.from_iterable(map(self.whole, v.cut.findall(marked) if v.cut else [marked])))


_LOADED: dict[tuple, object] = {}


def _loaded(kind, model):
    """One encoder or decoder for each model in a Python worker, kept from task to task."""
    key = kind, hash(model.value)
    if key not in _LOADED:
        _LOADED[key] = Encoder(Vocabulary(model.value)) if kind is Encoder else kind(model.value)
    return _LOADED[key]


def _runs(batch: pa.RecordBatch, at: int):
    """Slices of a batch with about RUN_BYTES of column ``at`` each."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
    start, done = 0, 0
    while start < len(size):
        stop = max(start + 1, int(np.searchsorted(size, done + RUN_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start, done = stop, int(size[stop - 1])


def _with_ids(model):
    def run(batches):
        encoder = _loaded(Encoder, model)
        for batch in batches:
            for part in _runs(batch, batch.num_columns - 1):
                rows = [encoder.encode(t) if t else [] for t in part.column(part.num_columns - 1).to_pylist()]
                offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
                flat = np.fromiter(chain.from_iterable(rows), np.int32, int(offsets[-1]))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.ListArray.from_arrays(offsets, flat)], names=[*part.schema.names[:-1], "ids"])

    return run


def _with_text(model):
    def run(batches):
        decoder = _loaded(Decoder, model)
        for batch in batches:
            ids = batch.column(batch.num_columns - 1)
            flat = ids.flatten()  # of the rows that are not null
            if flat.null_count:
                rows = [[i for i in r if i is not None] if r else [] for r in ids.to_pylist()]
            else:
                flat, at = flat.to_numpy(), np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))))
                rows = (flat[a:b].tolist() for a, b in zip(at[:-1].tolist(), at[1:].tolist()))
            texts = [decoder.decode(r) for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return run


def _model(df: DataFrame, model_path: str):
    """The model file's bytes for all tasks: one vocabulary, whose size the data do not change."""
    with open(model_path, "rb") as f:
        raw = f.read()
    _parsed(raw)  # an unsuitable model fails here, not in a task
    return df.sparkSession.sparkContext.broadcast(raw)


def _schema(df: DataFrame, name: str, kind) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def encode(docs: DataFrame, model_path: str, text: Column | str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` and ``ids`` (array of int), the BPE encoding of the whole text."""
    column = F.col(text) if isinstance(text, str) else text
    kept = docs.select(*carry)
    schema = _schema(kept, "ids", T.ArrayType(T.IntegerType()))
    return docs.select(*carry, column.cast("string").alias("_piece_text")).mapInArrow(_with_ids(_model(docs, model_path)), schema)


def decode(encoded: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """All columns and ``decoded``, the text of the ids (null: empty)."""
    others = [c for c in encoded.columns if c != ids]
    df = encoded.select(*others, ids)
    return df.mapInArrow(_with_text(_model(df, model_path)), _schema(df, "decoded", T.StringType()))
