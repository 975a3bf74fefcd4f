"""Quality rules by repetition coverage (operator 2).

Rolling hashes of word windows of several lengths, and of whole lines, are
computed in numpy over slices of an Arrow batch.  For each length the share of
a text's characters that lie inside a window found twice or more is its
coverage; a text whose coverage passes the threshold of any length, or that
consists too much of repeated lines, is not kept.

Edge cases: a null text counts as empty (0 words, fails the base rule); equal
rows get equal results; an empty table gives an empty result; extra columns
pass through ``filter_documents`` and are not read by ``measure``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .textarrays import SPACE, Texts, counts_between, lean, mix, prefix_sums, row_of, slices, span_hashes, word_windows

#: Window length in words -> largest share of a text's word characters that may
#: lie inside repeated windows of that length.
COVERAGE_LIMITS = {5: 0.25, 8: 0.20, 12: 0.15, 20: 0.12}
#: Largest share of a text's word characters in lines equal to an earlier line.
LINE_LIMIT = 0.30
#: The base rule: fewest words, and largest share of words in repeated windows of five.
MIN_WORDS, BASE_WINDOW, BASE_PERCENT = 10, 5, 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "base_failed boolean, dup_line_share double, "
            + ", ".join(f"coverage_{n} double" for n in COVERAGE_LIMITS) + ", kept boolean")


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which entries have an equal one anywhere, and which an equal one before them."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    ranked = keys[order]
    same[1:-1] = ranked[1:] == ranked[:-1]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return twice, later


def measure_texts(texts: Texts) -> dict[str, np.ndarray]:
    """All measures of the texts of one slice."""
    starts, ends, first = texts.words()
    prefix = texts.byte_prefix()
    word_hash = span_hashes(prefix, starts, ends)
    word_row = row_of(first)
    solid_chars = np.zeros(len(texts.buf) + 1, np.int64)
    np.cumsum(texts.char_starts() & ~SPACE[texts.buf], out=solid_chars[1:])
    word_len = solid_chars[ends] - solid_chars[starts]
    n_words = np.diff(first)
    word_chars = solid_chars[texts.off[1:]] - solid_chars[texts.off[:-1]]
    out = {"n_words": n_words, "word_chars": word_chars,
           "n_symbols": counts_between(_SYMBOL[texts.buf], texts.off)}

    line_start, line_end, line_first = texts.lines()
    line_row = row_of(line_first)
    line_chars = solid_chars[line_end] - solid_chars[line_start]
    written = np.flatnonzero(line_chars)
    keys = mix(span_hashes(prefix, line_start[written], line_end[written]) + mix(line_row[written] + 1))
    again = written[_repeated(keys)[1]]
    out["n_dup_lines"] = np.bincount(line_row[again], minlength=texts.n)
    total = np.maximum(word_chars, 1)
    out["dup_line_share"] = np.bincount(line_row[again], weights=line_chars[again], minlength=texts.n) / total

    kept = out["dup_line_share"] <= LINE_LIMIT
    for size, limit in COVERAGE_LIMITS.items():
        at, window = word_windows(word_hash, first, size)
        hit = at[_repeated(mix(window + mix(word_row[at] + 1)))[0]]
        edge = np.bincount(hit, minlength=len(starts) + 1) - np.bincount(hit + size, minlength=len(starts) + 1)
        inside = np.cumsum(edge[:-1]) > 0
        share = np.bincount(word_row[inside], weights=word_len[inside], minlength=texts.n) / total
        out[f"coverage_{size}"] = share
        kept &= share <= limit
        if size == BASE_WINDOW:
            out["n_repeat_words"] = np.bincount(word_row[inside], minlength=texts.n)
    out["base_failed"] = (n_words < MIN_WORDS) | (100 * out["n_repeat_words"] > BASE_PERCENT * n_words)
    out["kept"] = kept & ~out["base_failed"]
    return out


def _names() -> list[str]:
    return [part.split()[0] for part in MEASURES.split(", ")]


def measure(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id`` and all measures and verdicts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = measure_texts(Texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(found[c]) for c in _names())],
                                             ["doc_id", *_names()])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(lean(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {MEASURES}")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(measure_texts(Texts(batch.column("text")))["kept"]))

    return docs.mapInArrow(lean(run), docs.schema)


def op2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(table(spark, sf_dir, "documents"))



__all__ = ["COVERAGE_LIMITS", "LINE_LIMIT", "MEASURES", "filter_documents", "measure", "measure_texts", "op2_repetition"]
