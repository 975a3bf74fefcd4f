"""Numpy views of text columns: the shared helper of the operators that read
words, lines or characters inside Arrow batches.

A batch of texts is one byte buffer with offsets.  Words, lines and n-grams
are found for the whole buffer at once, and every span gets a 64-bit hash from
one prefix sum, so no Python object is made per word.  Batches are cut into
slices of bounded bytes first (a single longer text is a slice of its own).
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once inside a task.
SLICE_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

#: White space of the word rule: space and the bytes 09 to 0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


#: A random 64-bit value for each byte, the same in every process.
BYTE_VALUES = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))

_powers = {"up": np.ones(1, _U), "down": np.ones(1, _U)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse (mod 2^64)."""
    if len(_powers["up"]) < n:
        size = max(n, 2 * len(_powers["up"]), 4096)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=_U)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hashes`` reads any span's hash."""
    out = np.zeros(len(values) + 1, _U)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end); equal spans have equal hashes."""
    down = powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(_U) * _U(0xA24BAED4963EE407))


def free_memory() -> None:
    """Give memory that Arrow and the C library hold for later back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run: Callable, tokenizers: bool = False) -> Callable:
    """``run`` for ``mapInArrow``, with what a reused worker holds kept small: a
    task that needs no tokenizer drops those of earlier stages, and memory is
    given back when a task ends."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sys.modules.get("touchline.llm.tokenizer_files")
        if held is not None and not tokenizers:
            held.forget()
        try:
            yield from run(batches)
        finally:
            for name in _powers:
                _powers[name] = np.ones(1, _U)
            free_memory()

    return task


def counts_between(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many entries of ``mask`` are set in each [off[i], off[i+1])."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


class Texts:
    """The texts of one slice; a null text is empty."""

    def __init__(self, column: pa.Array):
        column = column.fill_null("") if column.null_count else column
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        n = len(column)
        _, offsets, data = column.buffers()
        off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        self.n = n
        self.buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
        self.off = off - off[0]
        self._bytes = None

    @classmethod
    def of(cls, texts: list) -> Texts:
        return cls(pa.array(texts, pa.large_string()))

    def byte_prefix(self) -> np.ndarray:
        if self._bytes is None:
            self._bytes = prefix_sums(BYTE_VALUES[self.buf])
        return self._bytes

    def char_starts(self) -> np.ndarray:
        """Mask of the bytes that begin a code point."""
        return (self.buf & 0xC0) != 0x80

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words (byte positions in ``buf``) and the word
        number at which each text begins (length n + 1)."""
        return self.spans(~SPACE[self.buf])

    def spans(self, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for the longest runs of the bytes marked in ``solid``."""
        filled = np.flatnonzero(np.diff(self.off))
        before = np.zeros_like(solid)
        before[1:] = solid[:-1]
        before[self.off[filled]] = False
        after = np.zeros_like(solid)
        after[:-1] = solid[1:]
        after[self.off[filled + 1] - 1] = False
        starts = np.flatnonzero(solid & ~before)
        ends = np.flatnonzero(solid & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.off)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r"""Starts and ends of the ``\n``-split lines and the line number at which each text begins."""
        breaks = np.flatnonzero(self.buf == 10)
        starts = np.sort(np.concatenate([self.off[:-1], breaks + 1]), kind="stable")
        ends = np.sort(np.concatenate([breaks, self.off[1:]]), kind="stable")
        first = np.concatenate([[0], np.cumsum(np.diff(np.searchsorted(breaks, self.off)) + 1)])
        return starts, ends, first


def word_windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start word and hash of every window of ``size`` words within one text."""
    last = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(np.arange(len(hashes)) + size <= last)
    return at, span_hashes(prefix_sums(hashes), at, at + size)


def row_of(first: np.ndarray) -> np.ndarray:
    """The text number of every word (line, ...), from where each text begins."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds at most ``max_bytes`` of text, or one row."""
    for batch in batches:
        col = batch.column(column)
        if not len(col):
            continue
        ends = np.cumsum(Texts(col).off[1:] - Texts(col).off[:-1])
        at = 0
        while at < len(col):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + max_bytes, "right")))
            yield batch.slice(at, to - at)
            at = to
