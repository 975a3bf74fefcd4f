"""Document fingerprints by content-defined chunking (operator 1).

A gear hash rolls over the UTF-8 bytes; a chunk ends where the hash passes a
mask, a strict one before the normal chunk length and a loose one after it
(normalised chunking), so lengths gather around the normal one and boundaries
move with the content: an insertion changes only the chunks around it.  The
fingerprint is the set of chunk digests with the chunks' lengths as weights,
written as base64 records of 5 digest bytes and 1 length byte in digest order.
``containment`` of one text in another is the weight of shared chunks over the
weight of the first text's chunks.

Edge cases: a null text is empty; an empty text has the empty fingerprint,
which is wholly contained in any other, and contains nothing of a non-empty
text.  Equal texts have equal fingerprints.  Repeated chunks of a text count
once.  Ties and repeated rows in the document order: see ``ordering``.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .ordering import with_successors
from .textarrays import BYTE_VALUES, SLICE_BYTES, Texts, mix, row_of, span_hashes

#: Chunk lengths in bytes.  The largest must fit one byte of the record.
MIN_CHUNK, NORMAL_CHUNK, MAX_CHUNK = 16, 32, 128
#: Bits of the 16-bit gear hash that must be zero at a boundary, before and after the normal length.
STRICT_BITS, LOOSE_BITS = 6, 4
#: Bytes of a digest in a record; one length byte follows.
DIGEST_BYTES = 5

_GEAR = (BYTE_VALUES >> np.uint64(48)).astype(np.uint16)


def gear_hashes(buf: np.ndarray) -> np.ndarray:
    """The gear hash h = 2 h + G[byte] (mod 2^16) at every byte, by doubling:
    it depends on the last 16 bytes only."""
    h = _GEAR[buf]
    for step in (1, 2, 4, 8):
        shifted = h[:-step] << np.uint16(step)
        h = h.copy()
        h[step:] += shifted
    return h


def _next_at(mask: np.ndarray) -> np.ndarray:
    """For each position the first set position at or after it (the length if none)."""
    n = len(mask)
    at = np.where(mask, np.arange(n, dtype=np.int32), np.int32(n))
    return np.minimum.accumulate(at[::-1])[::-1]


def chunk_ends(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all chunks in order, and the chunk number at which each text begins."""
    n = len(texts.buf)
    pad = np.full(MAX_CHUNK + 1, n, np.int32)
    h = gear_hashes(texts.buf)
    strict = np.concatenate([_next_at(h >> np.uint16(16 - STRICT_BITS) == 0), pad])
    loose = np.concatenate([_next_at(h >> np.uint16(16 - LOOSE_BITS) == 0), pad])
    # a boundary after byte b ends the chunk at b + 1; the first one allowed leaves MIN_CHUNK bytes
    at = np.arange(n, dtype=np.int32)
    first = strict[MIN_CHUNK - 1:MIN_CHUNK - 1 + n] + 1
    second = np.minimum(loose[NORMAL_CHUNK - 1:NORMAL_CHUNK - 1 + n] + 1, at + MAX_CHUNK)
    follow = np.where(first < at + NORMAL_CHUNK, first, second)
    row, at, stop = np.arange(texts.n), texts.off[:-1], texts.off[1:]
    rows, ends = [], []
    while True:
        live = at < stop
        if not live.all():
            row, at, stop = row[live], at[live], stop[live]
        if not len(row):
            break
        at = np.minimum(follow[at], stop)
        rows.append(row)
        ends.append(at)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(texts.n + 1, np.int64)
    ends = np.sort(np.concatenate(ends))
    counts = np.bincount(np.concatenate(rows), minlength=texts.n)
    return ends, np.concatenate([[0], np.cumsum(counts)])


class Fingerprints:
    """Digest sets of the texts of one slice: ``row``, ``digest`` and ``weight``
    of every distinct chunk, in order of row and digest."""

    def __init__(self, texts: Texts):
        ends, first = chunk_ends(texts)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        digest = span_hashes(texts.byte_prefix(), starts, ends) >> np.uint64(64 - 8 * DIGEST_BYTES)
        row, weight = row_of(first), ends - starts
        # the record orders by digest, then length
        record = (digest << np.uint64(8)) | weight.astype(np.uint64)
        order = np.lexsort((record, row))
        row, record = row[order], record[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (record[1:] != record[:-1])
        self.n, self.row, self.record = texts.n, row[new], record[new]
        self.weight = (self.record & np.uint64(255)).astype(np.int64)
        self.total = np.bincount(self.row, weights=self.weight, minlength=self.n)

    def strings(self) -> pa.Array:
        """One string per text: eight base64 characters for each chunk."""
        size = DIGEST_BYTES + 1
        data = self.record.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - size:].tobytes()
        text = base64.b64encode(data)
        off = np.zeros(self.n + 1, np.int64)
        np.cumsum(np.bincount(self.row, minlength=self.n) * (len(text) // max(1, len(self.record))), out=off[1:])
        return pa.Array.from_buffers(pa.large_string(), self.n, [None, pa.py_buffer(off.tobytes()), pa.py_buffer(text)])

    def contained_in(self, other: Fingerprints, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
        """Containment of row ``mine[i]`` in row ``theirs[i]`` of ``other`` for every i."""
        keys = mix(other.record + mix(other.row + 1))
        keys.sort()
        partner = np.full(self.n, -1)
        partner[mine] = theirs
        has = partner[self.row] >= 0
        row, record, weight = self.row[has], self.record[has], self.weight[has]
        look = mix(record + mix(partner[row] + 1))
        at = np.searchsorted(keys, look)
        found = np.zeros(len(look), bool)
        found[at < len(keys)] = keys[at[at < len(keys)]] == look[at < len(keys)]
        shared = np.bincount(row[found], weights=weight[found], minlength=self.n)
        return np.where(self.total > 0, shared / np.maximum(self.total, 1), 1.0)[mine]


def parse(fingerprint: str) -> dict[tuple[int, int], int]:
    """(digest, length) -> weight of a fingerprint string."""
    raw, size = base64.b64decode(fingerprint), DIGEST_BYTES + 1
    records = [raw[i:i + size] for i in range(0, len(raw), size)]
    return {(int.from_bytes(r[:-1], "big"), r[-1]): r[-1] for r in records}


def containment(a: str, b: str) -> float:
    """Weight of the chunks of ``a`` that ``b`` has too, over the weight of ``a``."""
    a, b = parse(a), parse(b)
    return sum(w for c, w in a.items() if c in b) / sum(a.values()) if a else 1.0


def fingerprint(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .textarrays import slices
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), Fingerprints(Texts(batch.column("text"))).strings().cast(pa.string())],
                ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much, or all, of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


EDIT_COLUMNS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                "near_edited double, near_next double")


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], list[str]]]:
    """(ids, texts, next texts) of bounded size from rows in ``with_successors`` order."""
    ids, texts, size, now = [], [], 0, None
    for batch in batches:
        for where, halo, doc, text in zip(*(batch.column(c).to_pylist() for c in ("range", "halo", "doc_id", "text")), strict=True):
            if now is not None and where != now:
                ids, texts, size = [], [], 0  # the halo row has closed the range before
            if now == where and texts and ids[-1] is _CLOSED:
                continue  # a further copy of the head
            now = where
            ids.append(_CLOSED if halo else doc)
            texts.append(text)
            size += len(text)
            if (halo or size > SLICE_BYTES // 2) and len(texts) > 1:
                yield ids[:-1], texts[:-1], texts[1:]
                ids, texts, size = ids[-1:], texts[-1:], 0 if halo else len(text)


_CLOSED = object()


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """The fingerprint of every document and of its edited text, with the
    containment of the document in the edited text and in the next document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, following in _windows(batches):
            changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
            own = Fingerprints(Texts.of(texts + following[-1:]))
            other = Fingerprints(Texts.of(changed))
            at = np.arange(len(ids))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([len(x) for x in texts], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed]),
                own.strings()[:-1].cast(pa.string()), other.strings().cast(pa.string()),
                pa.array(own.contained_in(other, at, at)), pa.array(own.contained_in(own, at, at + 1)),
            ], [c.split()[0] for c in EDIT_COLUMNS.split(", ")])

    return with_successors(docs).mapInArrow(run, EDIT_COLUMNS)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
