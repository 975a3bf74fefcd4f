"""Substring dedup by content-defined chunking (operator 4).

A gear hash rolls over the words of a text; a chunk begins at a word whose
rolling hash is least among its neighbours (LOOK words on both sides), so a
boundary depends on nearby words alone and the chunks of a shared passage are
the same wherever it stands: an insertion changes only the chunks next to it.
A stretch without such a word, like one word repeated, is cut every LONGEST
words.  Chunks with a digest that occurred before (in order of ``doc_id``,
then place) are repeats.  A run of neighbouring repeats with at least MIN_WORDS
words is removed; shorter runs stay, they are common phrases.  The first
occurrence of every chunk stays.

Edge cases: a null text is empty in the result's measures and stays null in
``deduplicate``; an empty or short text has at most one chunk.  Null ids come
last in the order.  Of rows equal in ``doc_id`` and text one comes first, and
the others repeat it from end to end.  An empty table gives an empty result;
extra columns pass through ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty, write_scratch
from .textarrays import Texts, lean, row_of, slices, span_hashes, prefix_sums

#: Neighbours on each side that a boundary's hash is least among; longest chunk; words of a removed run.
LOOK, LONGEST, MIN_WORDS = 3, 32, 25
#: Bits by which the gear hash shifts at each word: it depends on the last 64 / GEAR_SHIFT words.
GEAR_SHIFT = 16

_KEEP_LAST = 1 << 62
#: A place that stands for all chunks of a text.
_ALL = -1


def chunk_starts(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mask of the words that begin a chunk; every text's first word does."""
    n = len(words)
    row = row_of(first)
    h = words.copy()  # h = (h << GEAR_SHIFT) + G[word] mod 2^64, anew in every text
    for back in range(1, 64 // GEAR_SHIFT):
        h[back:] += np.where(row[back:] == row[:-back], words[:-back] << np.uint64(back * GEAR_SHIFT), np.uint64(0))
    begin = np.zeros(n, bool)
    begin[first[:-1][np.diff(first) > 0]] = True
    least = np.ones(n, bool)
    for step in range(1, LOOK + 1):
        same = row[step:] == row[:-step]
        least[step:] &= ~same | (h[step:] < h[:-step])
        least[:-step] &= ~same | (h[:-step] <= h[step:])
    begin |= least
    at = np.flatnonzero(begin)
    gap = np.diff(np.append(at, n))
    for k in np.flatnonzero(gap > LONGEST):
        begin[at[k]:at[k] + gap[k]:LONGEST] = True
    return begin


class Chunks:
    """Chunks of the texts of one slice: ``first`` and ``size`` in words, digest,
    and where each text's begin."""

    def __init__(self, texts: Texts):
        self.starts, self.ends, self.word_first = texts.words()
        words = span_hashes(texts.byte_prefix(), self.starts, self.ends)
        self.first = np.flatnonzero(chunk_starts(words, self.word_first))
        self.size = np.diff(np.append(self.first, len(words)))
        self.begin = np.searchsorted(self.first, self.word_first)
        self.digest = span_hashes(prefix_sums(words), self.first, self.first + self.size)


def chunk_table(docs: DataFrame) -> DataFrame:
    """``digest``, ``doc`` (order key: id and text hash) and ``place`` of every chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            chunks = Chunks(Texts(batch.column("text")))
            row = row_of(chunks.begin)
            place = np.arange(len(row)) - chunks.begin[row]
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunks.digest.view(np.int64)), batch.column("id").take(rows), batch.column("hash").take(rows),
                 pa.array(place.astype(np.int32))], ["digest", "id", "hash", "place"])

    return docs.mapInArrow(lean(run), "digest long, id long, hash long, place int")


def keyed(docs: DataFrame) -> DataFrame:
    """The documents' order key: ids (null last), then the text's hash."""
    return docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_KEEP_LAST)),
                             "__hash": F.xxhash64(text_or_empty())})


def repeats(docs: DataFrame) -> DataFrame:
    """``id``, ``hash`` and the sorted ``places`` of all repeated chunks of a
    document, with ``sources``, the ids of the documents that keep them."""
    plain = keyed(docs).select(F.col("__id").alias("id"), F.col("__hash").alias("hash"), text_or_empty().alias("text"))
    chunks = write_scratch(chunk_table(plain), "chunks")
    first = (chunks.groupBy("digest").agg(F.min("id").alias("source"), F.count("*").alias("n"))
             .filter("n > 1").select("digest", "source"))
    shared = write_scratch(chunks.join(first, "digest"), "shared-chunks")
    # under the least id itself, the first by text hash and place is the one that stays
    at, own = F.struct("hash", "place"), shared.filter("id = source")
    twice = own.join(own.groupBy("digest").agg(F.min(at).alias("kept")), "digest").filter(at != F.col("kept"))
    columns = ("id", "hash", "place", "source")
    again = shared.filter("id > source").select(*columns).unionAll(twice.select(*columns))
    return again.groupBy("id", "hash").agg(F.array_sort(F.collect_set("place")).alias("places"),
                                           F.array_sort(F.collect_set("source")).alias("sources"))


def removed_spans(texts: Texts, places: list) -> tuple[list, list]:
    """For each text its removed byte spans, and the new text."""
    chunks = Chunks(texts)
    raw = texts.buf.tobytes()
    spans, new = [], []
    for i, where in enumerate(places):
        lo, hi = int(texts.off[i]), int(texts.off[i + 1])
        cut = []
        if where:
            at = np.asarray(where, np.int64)
            if at[0] == _ALL:
                at = np.arange(chunks.begin[i + 1] - chunks.begin[i])
            at = at[at < chunks.begin[i + 1] - chunks.begin[i]] + chunks.begin[i]
            breaks = np.flatnonzero(np.diff(at) != 1) + 1
            for run in np.split(at, breaks):
                if len(run) and chunks.size[run].sum() >= MIN_WORDS:
                    last = chunks.first[run[-1]] + chunks.size[run[-1]] - 1
                    cut.append((int(chunks.starts[chunks.first[run[0]]]), int(chunks.ends[last])))
        kept, done = [], lo
        for a, b in cut:
            kept.append(raw[done:a])
            done = b
        kept.append(raw[done:hi])
        spans.append([(a - lo, b - lo) for a, b in cut])
        new.append(b"".join(kept).decode())
    return spans, new


def _with_repeats(docs: DataFrame, *columns: str) -> DataFrame:
    """The given columns of the documents with ``places`` and ``sources`` (null: no repeat)."""
    found = repeats(docs).withColumnsRenamed({"id": "__id", "hash": "__hash"})
    order = ["__id", "__hash"]
    rows = keyed(docs).select(*order, *columns)
    equal = write_scratch(rows.groupBy(*order).count().filter("count > 1").select(*order), "equal-rows")
    if equal.isEmpty():
        return rows.join(found, order, "left")
    # rows that are equal in id and text get numbers, once; the least of a group is the first
    group = write_scratch(rows.join(equal, order, "left_semi").withColumn("__number", F.monotonically_increasing_id()), "equal-texts")
    first = group.groupBy(*order).agg(F.min("__number").alias("__number")).select("__number")
    single = rows.join(equal, order, "left_anti").unionByName(group.join(first, "__number", "left_semi").drop("__number"))
    copies = group.join(first, "__number", "left_anti").drop("__number").withColumns(
        {"places": F.array(F.lit(_ALL)), "sources": F.array("__id")})
    return single.join(found, order, "left").unionByName(copies)


def removals(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the remaining ``text``, ``removed_chars``,
    ``removed_spans`` (code points, end exclusive) and ``source_ids``, the documents
    that keep the repeated chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = Texts(batch.column("text"))
            spans, new = removed_spans(texts, batch.column("places").to_pylist())
            chars = np.zeros(len(texts.buf) + 1, np.int64)
            np.cumsum(texts.char_starts(), out=chars[1:])
            points = [[{"start": int(chars[lo + a] - chars[lo]), "end": int(chars[lo + b] - chars[lo])} for a, b in row]
                      for lo, row in zip(texts.off, spans)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(new, pa.string()),
                pa.array([sum(s["end"] - s["start"] for s in row) for row in points], pa.int64()),
                pa.array(points, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array([found if row else [] for found, row in zip(batch.column("sources").to_pylist(), spans, strict=True)], pa.list_(pa.int64())),
            ], ["doc_id", "text", "removed_chars", "removed_spans", "source_ids"])

    rows = _with_repeats(docs.select("doc_id", "text"), "doc_id", "text").select("doc_id", text_or_empty().alias("text"), "places", "sources")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"doc_id {kind}, text string, removed_chars long, "
                                "removed_spans array<struct<start: long, end: long>>, source_ids array<long>")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents without their repeated runs, ``n_chars`` counted anew; a
    document of which no word is left goes, unless it had none before."""
    names = docs.columns
    wrapped = _with_repeats(docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row")), "__row")
    changed = wrapped.filter("places is not null").select("__row", F.col("__row.text").alias("text"), "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            _, new = removed_spans(Texts(batch.column("text")), batch.column("places").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("__row"), pa.array(new, pa.string())], ["__row", "__new"])

    row = docs.schema.simpleString()
    done = changed.mapInArrow(lean(run), f"__row {row}, __new string").filter(F.col("__new").rlike(r"[^\x20\x09-\x0D]"))
    own = {c: F.col(f"__row.`{c}`") for c in names}
    new = own | {"text": F.col("__new")}
    if "n_chars" in names:
        new["n_chars"] = F.length("__new").cast(docs.schema["n_chars"].dataType)
    same = wrapped.filter("places is null").select(*[c.alias(k) for k, c in own.items()])
    return same.unionAll(done.select(*[c.alias(k) for k, c in new.items()]))


def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removals(table(spark, sf_dir, "documents"))
