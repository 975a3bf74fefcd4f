"""Ranked lexical search by NRA, the threshold algorithm without random access (operator 13).

Queries are the texts of an item table, each against all documents.  The work
is cut by documents: a shard of documents holds, for every query term, the
list of its documents sorted by falling impact, with the statistics (document
counts and lengths) of the whole corpus.  For one item the shard's lists are
read from their tops, all to the same depth, which doubles from round to round.
Every document met has an interval for its score:

* lower: the sum of the impacts read so far,
* upper: lower plus, for each list in which it has not been met, that list's
  frontier, the impact that would be read next.

A document that was met nowhere has the sum of all frontiers as its upper end.
Reading goes on until no unmet document can reach the 20th lower end, and
every document whose upper end reaches it has lower = upper.  Ends that are
equal count as reaching, so membership, ties and final scores are all settled.
A shard's best are merged by one window per item, cut to 20 rows in every task
before they move.

A block of items is searched at once; the vocabulary of a block (at most
BLOCK_TERMS terms, or one item) is what tasks are sent.  Terms are compared by
64-bit hashes.

Edge cases: a null text has no term; a document or item without terms is in no
result; a term that an item repeats counts as often; items that repeat, or have
no id, are searched each; null document ids rank behind others of the same
score; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, text_or_empty, write_scratch
from .textarrays import Texts, lean, row_of, slices, span_hashes

#: Documents returned for each item; first depth of a round; postings of a shard; terms of a block of items.
TOP, FIRST_DEPTH, SHARD_POSTINGS, BLOCK_TERMS = 20, 32, 1 << 20, 1 << 18

_TERM = np.zeros(256, bool)  # bytes of terms: digits, letters, and all of characters beyond ASCII
_TERM[0x30:0x3A] = _TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def term_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, and the term number at which each text begins."""
    low = Texts.__new__(Texts)
    low.n, low.buf, low.off, low._bytes = texts.n, _LOWER[texts.buf], texts.off, None
    starts, ends, first = low.spans(_TERM[low.buf])
    return span_hashes(low.byte_prefix(), starts, ends), first


@dataclass
class Queries:
    """A block of items: the sorted hashes of their terms, and for each item the
    places of its terms there with how often it has them."""

    vocabulary: np.ndarray
    items: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, texts: list[str | None]) -> Queries:
        hashes, first = term_hashes(Texts.of(texts))
        vocabulary = np.unique(hashes)
        parts = [np.unique(np.searchsorted(vocabulary, hashes[a:b]), return_counts=True) for a, b in zip(first[:-1], first[1:], strict=True)]
        return cls(vocabulary, parts)


def document_terms(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``doc_id``, ``n`` (all its terms), and ``terms`` with ``counts``: the places of
    the vocabulary's terms that it has.  Documents without terms are left out."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in slices(batches):
            hashes, first = term_hashes(Texts(batch.column("text")))
            n = np.diff(first)
            place = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
            hit = known[place] == hashes if len(known) else np.zeros(len(hashes), bool)
            keys, counts = np.unique(row_of(first)[hit] * max(len(known), 1) + place[hit], return_counts=True)
            row, term = np.divmod(keys, max(len(known), 1))
            some = np.flatnonzero(n)
            at = np.searchsorted(row, np.append(some, len(n)))
            at[-1] = len(row)
            lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(v, pa.int32())) for v in (term, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(some)), pa.array(n[some]), *lists],
                                             ["doc_id", "n", "terms", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        lean(run), f"doc_id {kind}, n long, terms array<int>, counts array<int>")


class Shard:
    """The impact-sorted lists of some documents."""

    def __init__(self, n: np.ndarray, first: np.ndarray, terms: np.ndarray, counts: np.ndarray, size: int, documents: int, length: int):
        """``size`` terms in the vocabulary; ``documents`` and ``length`` of the corpus."""
        m = 75 + (25 * n * documents) // length
        tf, doc = counts.astype(np.int64), row_of(first)
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
        order = np.lexsort((-impact, terms))
        self.docs, self.impact = doc[order], impact[order]
        self.begin = np.searchsorted(terms[order], np.arange(size + 1))
        self.lower = np.zeros(len(n), np.int64)

    def best(self, terms: np.ndarray, weights: np.ndarray, top: int = TOP, depth: int = FIRST_DEPTH) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and exact scores of all that may be among the ``top`` best of one
        item (whole ties), and the number of postings read.  ``weights`` hold the
        item's repeats."""
        use = weights > 0
        at, end, weights = self.begin[terms[use]].copy(), self.begin[terms[use] + 1], weights[use]
        lower = self.lower  # zero between calls
        met, seen = np.zeros(0, np.int64), np.zeros((len(lower), len(at)), bool)
        open_to_new, read = True, 0
        while True:
            new = []
            for t in range(len(at)):
                stop = min(int(end[t]), int(at[t]) + depth)
                docs = self.docs[at[t]:stop]  # each document is at most once in a list
                lower[docs] += weights[t] * self.impact[at[t]:stop]
                seen[docs, t] = True
                new.append(docs)
                read += stop - int(at[t])
                at[t] = stop
            if open_to_new and new:
                met = np.union1d(met, np.concatenate(new))
            depth *= 2
            left = np.flatnonzero(at < end)
            frontier = np.zeros(len(at), np.int64)
            frontier[left] = weights[left] * self.impact[at[left]]
            low = lower[met]
            high = low + frontier.sum() - seen[met] @ frontier
            bar = int(np.partition(low, len(low) - top)[len(low) - top]) if len(low) >= top else 0
            # a document below the bar stays below: the bar only rises and upper ends only fall
            met, low, high = (x[high >= max(bar, 1)] for x in (met, low, high))
            if open_to_new:
                open_to_new = int(frontier.sum()) >= max(bar, 1)
            if not open_to_new and (low == high).all():
                lower[:] = 0
                return met, low, read


def search_block(docs: DataFrame, queries: Queries, top: int = TOP) -> DataFrame:
    """``item`` (its number in the block), ``doc_id`` and ``score``: the best documents of every shard."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = write_scratch(document_terms(docs, queries.vocabulary), "document-terms")
    corpus = held.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    documents, length = int(corpus["documents"]), max(1, int(corpus["length"]))
    df = np.zeros(len(queries.vocabulary), np.int64)
    for r in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the block's terms
        df[r["term"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    size, sent = len(df), spark.sparkContext.broadcast([(terms, weights[terms] * times) for terms, times in queries.items])

    def answers(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        terms, counts = (rows.column(c).combine_chunks() for c in ("terms", "counts"))
        first = np.append(0, np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False)))
        shard = Shard(rows.column("n").to_numpy(), first, terms.flatten().to_numpy(), counts.flatten().to_numpy(), size, documents, length)
        ids = rows.column("doc_id").combine_chunks()
        # places of the documents in order of their ids, null ids last
        rank = np.empty(len(ids), np.int64)
        rank[pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        items, found, scores = [], [], []
        for number, (which, gains) in enumerate(sent.value):
            met, score, _ = shard.best(which, gains, top)
            keep = np.lexsort((rank[met], -score))[:top]
            items.append(np.full(len(keep), number, np.int64))
            found.append(met[keep])
            scores.append(score[keep])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(items)), ids.take(pa.array(np.concatenate(found))),
                                           pa.array(np.concatenate(scores))], ["item", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, postings = [], 0
        for batch in batches:
            parts.append(batch)
            postings += len(batch.column("terms").flatten())
            if postings >= SHARD_POSTINGS:
                yield answers(parts)
                parts, postings = [], 0
        if any(p.num_rows for p in parts) and sent.value:
            yield answers(parts)

    return held.mapInArrow(lean(run), f"item long, doc_id {kind}, score long")


def blocks(items: DataFrame, most: int = BLOCK_TERMS) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of the items, in blocks whose texts cannot hold more than
    ``most`` terms (or are one).  Items reach the driver one partition at a time."""
    ids, texts, size = [], [], 0
    for r in items.select("item_id", "text").toLocalIterator():
        bound = len(r["text"] or "") // 2 + 1  # a term and what parts it from the next
        if texts and size + bound > most:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r["item_id"])
        texts.append(r["text"])
        size += bound
    if texts:
        yield ids, texts


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of every item's ``top`` documents."""
    spark = docs.sparkSession
    kinds = {c: d.schema[c].dataType.simpleString() for d, c in ((items, "item_id"), (docs, "doc_id"))}
    out = spark.createDataFrame([], f"item_id {kinds['item_id']}, rank int, doc_id {kinds['doc_id']}, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for ids, texts in blocks(items):
        found = search_block(docs, Queries.of(texts), top)
        best = write_scratch(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top), "best")
        names = spark.createDataFrame(list(enumerate(ids)), f"item long, item_id {kinds['item_id']}")  # one block's items
        out = out.unionAll(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out


def op13_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS_SQL = (r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))")
OP13_SQL = f"""
WITH documents_keyed AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
items AS (SELECT row_number() OVER () AS item, item_id, text FROM benchmark),
words AS (SELECT row, doc_id, {_TERMS_SQL} AS term FROM documents_keyed),
postings AS (SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT row, count(*) AS n FROM words GROUP BY row),
corpus AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM lengths),
asked AS (SELECT item, item_id, {_TERMS_SQL} AS term FROM items),
counted AS (SELECT item, item_id, term, count(*) AS times FROM asked GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, corpus WHERE term IN (SELECT term FROM counted) GROUP BY term),
impacts AS (
  SELECT p.row, p.doc_id, p.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * documents) // length)))) AS impact
  FROM postings p JOIN weights USING (term) JOIN lengths USING (row), corpus),
scored AS (
  SELECT item, item_id, row, doc_id, CAST(sum(times * impact) AS BIGINT) AS score
  FROM counted JOIN impacts USING (term) GROUP BY ALL HAVING sum(times * impact) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
