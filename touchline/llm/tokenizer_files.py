"""Tokenizer files by path, opened once per Python worker."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np

from .textarrays import Texts, mix, span_hashes


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The ``tokenizers`` tokenizer at ``path``, without padding or truncation, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_padding()
    out.no_truncation()
    return out


class PieceEncoder:
    """Ids of pieces of text, each distinct piece encoded once by the library.

    The caller cuts texts where no token can reach across.  Known pieces are
    held by hash in a pool of bounded size, which starts anew when it is full."""

    MOST_PIECES, MOST_IDS = 500_000, 5_000_000

    def __init__(self, encode: Callable[[list[str]], list[list[int]]]):
        self.encode = encode
        self._clear()

    def _clear(self) -> None:
        self.keys, self.rank = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted hashes; the piece of each
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0
        self.begin = np.zeros(1, np.int64)  # piece r has the ids from begin[r] to begin[r + 1]

    def _learn(self, keys: np.ndarray, strings: list[str]) -> None:
        lists = self.encode(strings)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        end = self.used + int(sizes.sum())
        if end > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(end, len(self.pool)), np.int32)])
        self.pool[self.used:end] = np.fromiter(chain.from_iterable(lists), np.int32, end - self.used)
        rank = np.concatenate([self.rank, len(self.begin) - 1 + np.arange(len(lists))])
        self.begin = np.concatenate([self.begin, self.used + np.cumsum(sizes)])
        self.used = end
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")  # two sorted runs
        self.keys, self.rank = keys[order], rank[order]

    def pieces(self, texts: Texts, starts: np.ndarray, ends: np.ndarray, led: np.ndarray | None = None, lead: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pool of ids, and where in it each piece's ids begin and end.  The
        pieces marked in ``led`` are encoded with ``lead`` before them."""
        if len(self.keys) > self.MOST_PIECES or self.used > self.MOST_IDS:
            self._clear()
        hashes = span_hashes(texts.byte_prefix(), starts, ends)
        if led is not None:
            hashes[led] = mix(hashes[led])
        keys, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        held = place < len(self.keys)
        held[held] = self.keys[place[held]] == keys[held]
        new = np.flatnonzero(~held)
        if len(new):
            raw, first = texts.buf.tobytes(), at[new]
            before = [lead if x else "" for x in led[first]] if led is not None else [""] * len(new)
            self._learn(keys[new], [x + raw[a:b].decode() for x, a, b in
                                    zip(before, starts[first].tolist(), ends[first].tolist(), strict=True)])
        rank = self.rank[np.searchsorted(self.keys, keys)][which]
        return self.pool, self.begin[rank], self.begin[rank + 1]


@lru_cache(maxsize=4)
def piece_encoder(path: str) -> PieceEncoder:
    held = tokenizer(path)
    return PieceEncoder(lambda strings: [x.ids for x in held.encode_batch_fast(strings, add_special_tokens=False)])


def forget() -> None:
    """Drop all tokenizers and pieces of this worker."""
    tokenizer.cache_clear()
    piece_encoder.cache_clear()


def gather(pool: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The ids of all pieces, one after the other."""
    size = end - begin
    return pool[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())]
