"""SentencePiece encoding and decoding by a weighted finite-state transducer (operator 3).

Compiled from a model file:

* the normaliser, which puts the dummy space before a text and writes spaces as
  the model's space mark;
* a lexicon transducer whose states are the beginnings of pieces: reading a
  character moves to the longest beginning that the text now ends with, and
  gives the arcs of all pieces that end here, weighted by their scores;
* byte fallback, the path of byte pieces over a character that no piece has.

A text composed with this is a lattice; its shortest path in the tropical
semiring (least sum of weights) gives the ids.  A unigram model needs nothing
else.  A byte-pair model's encoding is not the path of least score sum: it is
the only path on which every two neighbours, encoded together, stay apart as
they are (a merge over their border would otherwise have come first).  So for
such a model the lexicon is composed with an acceptor whose states are pieces,
with an arc of weight 0 for each such pair and none (infinite weight) for the
others, found as they are needed.  Every prefix of a text has one path left.

Texts are composed piecewise, cut before a space behind another character and
around line breaks, where the model has no piece that goes across; each
distinct stretch of a worker is solved once.

Edge cases: a null text is empty and has no ids; characters unknown to the
model give byte pieces; decoding gives back every text whose characters the
normaliser keeps (the space mark itself is read as a space); equal texts get
equal ids; an empty table gives an empty result.  Models with a character map
or with removal of extra white space are refused when compiled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .textarrays import Texts, slices
from .tokenizer_files import PieceEncoder, gather, vocabulary

SPACE_MARK = "▁"
UNIGRAM, BYTE_PAIRS = 1, 2
#: A state behind a character that no piece has.
UNKNOWN = -1
#: A unigram path over an unknown character costs this more than the worst piece.
UNKNOWN_PENALTY = 10.0


class Transducer:
    def __init__(self, pieces: list[tuple[str, float]], normal: list[bool], byte_ids: list[int], kind: int, dummy_space: bool = True):
        """``pieces``: string and score of every id; ``normal``: the ids that text
        can match; ``byte_ids``: the ids of the 256 byte pieces (or none)."""
        self.strings = [p for p, _ in pieces]
        self.scores = [s for _, s in pieces]
        self.lexicon = {p: i for i, p in enumerate(self.strings) if normal[i]}
        self.prefixes = {p[:n] for p in self.lexicon for n in range(len(p) + 1)} | {""}
        self.byte_ids, self.kind, self.dummy_space = byte_ids, kind, dummy_space
        spelled = [p.replace(SPACE_MARK, " ").encode() if normal[i] else b"" for i, p in enumerate(self.strings)]
        for value, i in enumerate(byte_ids):
            spelled[i] = bytes([value])
        self.spelled = spelled
        self.cut_at_spaces = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.lexicon)
        self.cut_at_lines = not any("\n" in p for p in self.lexicon)
        self.unknown_weight = UNKNOWN_PENALTY - min(self.scores, default=0.0)
        self._apart: dict[int, bool] = {}
        self._moves: dict[str, tuple[str, tuple[tuple[int, int], ...]]] = {}

    @classmethod
    def from_file(cls, path: str) -> Transducer:
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, kind = model.normalizer_spec, model.trainer_spec.model_type
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models that keep characters and white space can be compiled")
        if kind not in (UNIGRAM, BYTE_PAIRS) or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"model type {kind} is not supported")
        types = [p.type for p in model.pieces]
        plain = proto.ModelProto.SentencePiece
        if plain.USER_DEFINED in types or plain.UNUSED in types:
            raise ValueError("models with user-defined or unused pieces are not supported")
        byte_ids = [i for i, t in enumerate(types) if t == plain.BYTE]
        return cls([(p.piece, p.score) for p in model.pieces], [t == plain.NORMAL for t in types], byte_ids, kind, spec.add_dummy_prefix)

    # the normaliser

    def normalise(self, text: str) -> str:
        return ((" " if self.dummy_space and text else "") + text).replace(" ", SPACE_MARK)

    # the acceptor of neighbouring byte-pair pieces

    def _merged(self, text: str) -> list[str]:
        """The byte-pair encoding of a few characters, merge by merge."""
        parts = list(text)
        while True:
            best, at = -math.inf, -1
            for i in range(len(parts) - 1):
                found = self.lexicon.get(parts[i] + parts[i + 1])
                if found is not None and self.scores[found] > best:
                    best, at = self.scores[found], i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def apart(self, a: int, b: int) -> bool:
        """Whether piece ``b`` can follow ``a`` (UNKNOWN: nothing, or an unknown character)."""
        if len(self._apart) > 2_000_000:
            self._apart.clear()
        want = [self.strings[b]] if a == UNKNOWN else [self.strings[a], self.strings[b]]
        found = self._apart[(a + 1) * len(self.strings) + b] = self._merged("".join(want)) == want
        return found

    # composition and shortest path

    def move(self, read: str) -> tuple[str, tuple[tuple[int, int], ...]]:
        """The lexicon's next state and its arcs (length and id of the pieces that
        end here, longest first) for ``read``, a state and the character behind it."""
        if len(self._moves) > 1_000_000:
            self._moves.clear()
        state = read
        while state not in self.prefixes:
            state = state[1:]
        endings = [state[i:] for i in range(len(state))]
        found = self._moves[read] = state, tuple((len(e), self.lexicon[e]) for e in endings if e in self.lexicon)
        return found

    def _least_path(self, text: str, state: list[int], back: list[int]) -> None:
        """Relaxation over the lexicon's arcs, weighted by the pieces' scores."""
        weight, at = [0.0], ""
        for end, char in enumerate(text, 1):
            at, arcs = self._moves.get(at + char) or self.move(at + char)
            weight.append(weight[end - 1] + self.unknown_weight)
            for length, piece in arcs:
                if weight[end - length] - self.scores[piece] < weight[end]:
                    weight[end], state[end], back[end] = weight[end - length] - self.scores[piece], piece, end - length

    def _only_path(self, text: str, state: list[int], back: list[int]) -> None:
        """With weights 0 and infinity: at each position the one arc that the acceptor has."""
        moves, known, size, at = self._moves.get, self._apart.get, len(self.strings), ""
        for end, char in enumerate(text, 1):
            at, arcs = moves(at + char) or self.move(at + char)
            for length, piece in arcs:
                before = state[end - length]
                ok = known((before + 1) * size + piece)
                if ok or ok is None and self.apart(before, piece):
                    state[end], back[end] = piece, end - length
                    break

    def ids_of(self, normalised: str) -> list[int]:
        """Ids along the shortest path over a normalised text."""
        at = len(normalised)
        state, back = [UNKNOWN] * (at + 1), list(range(-1, at))  # at first: every character by byte fallback
        (self._only_path if self.kind == BYTE_PAIRS else self._least_path)(normalised, state, back)
        out: list[int] = []
        while at:
            if state[at] != UNKNOWN:
                out.append(state[at])
            else:
                out.extend(self.byte_ids[b] for b in reversed(normalised[at - 1].encode()))
            at = back[at]
        out.reverse()
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text, composed whole."""
        return self.ids_of(self.normalise(text))

    def decode(self, ids) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids)).decode(errors="replace")
        return text[1:] if self.dummy_space and text.startswith(" ") else text

    # many texts

    def stretches(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and text starts (mask) of the stretches that are composed on their own."""
        buf = texts.buf
        cut = np.zeros(len(buf), bool)
        begins = np.zeros(len(buf), bool)
        begins[texts.off[:-1][np.diff(texts.off) > 0]] = True
        if self.cut_at_spaces:
            # the last byte of the space mark is 0x81: such places are simply not cut
            cut[1:] = (buf[1:] == 0x20) & (buf[:-1] != 0x20) & (buf[:-1] != 0x81)
        if self.cut_at_lines:
            line = buf == 0x0A
            cut |= line
            cut[1:] |= line[:-1]
        starts = np.flatnonzero(cut | begins)
        return starts, np.append(starts[1:], len(buf)), begins[starts]


@lru_cache(maxsize=2)
def transducer(path: str) -> tuple[Transducer, PieceEncoder]:
    held = Transducer.from_file(path)
    return held, PieceEncoder(lambda strings: [held.ids_of(s.replace(" ", SPACE_MARK)) for s in strings])


def encode_texts(texts: Texts, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, and where each text's begin."""
    held, pieces = transducer(path)
    starts, ends, leads = held.stretches(texts)
    pool, begin, end = pieces.pieces(texts, starts, ends, leads if held.dummy_space else None, " ")
    row = np.searchsorted(texts.off, starts, "right") - 1
    sizes = np.bincount(row, weights=end - begin, minlength=texts.n).astype(np.int64)
    return gather(pool, begin, end), np.concatenate([[0], np.cumsum(sizes)])


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_ids``, ``ids`` and ``decoded`` (the text read back from the ids) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = transducer(path)[0]
        for batch in slices(batches):
            ids, off = encode_texts(Texts(batch.column("text")), path)
            decoded = [held.decode(ids[a:b].tolist()) for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.diff(off)),
                pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32())), pa.array(decoded, pa.string()),
            ], ["doc_id", "n_ids", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_ids long, ids array<int>, decoded string")


def op3_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
