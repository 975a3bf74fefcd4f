"""Quality classifier by supervised subword embeddings (operator 6).

A document is the average of learned vectors of its hashed words, neighbouring
word pairs and character n-grams; a softmax layer on the average gives the
class probabilities.  Vectors and layer are trained by numpy stochastic
gradient descent on a bounded sample of labelled documents, in one task.
Because the layer is linear in the average, a trained model folds every vector
into one weight per bucket, which is what scoring broadcasts (1 MB).

A word pair is hashed by the difference of its word hashes, so that a word
that follows itself falls into one bucket whatever the word is.

Edge cases: a null text is empty; an empty text has no feature and gets the
score of the bias alone; equal texts get equal scores.  Label rows without a
``doc_id`` or a label, and documents labelled both ways, are not learned from;
without usable labels of both classes every score is 0.5.  An empty table
gives an empty result; extra columns pass through ``accepted_documents``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import table, text_or_empty
from .textarrays import Texts, lean, mix, row_of, slices, span_hashes

#: Hash buckets (2 to this power), vector length, and character n-gram lengths.
BUCKET_BITS, DIMENSIONS, CHAR_GRAMS = 18, 16, (3, 4)
#: The bound of the training sample: about so many documents of each class, one row
#: for each ``doc_id``, and of each so many characters.
SAMPLE_PER_CLASS, SAMPLE_CHARS = 2000, 100_000
#: Passes over the sample and the learning rates of vectors and output layer.
EPOCHS, VECTOR_RATE, LAYER_RATE, SEED = 6, 40.0, 0.5, 17

_U = np.uint64
_MASK = _U((1 << BUCKET_BITS) - 1)


def feature_groups(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of features: bucket of every feature in text order, and the number
    of the feature at which each text's begin."""
    prefix = texts.byte_prefix()
    starts, ends, first = texts.words()
    words = span_hashes(prefix, starts, ends)
    yield (mix(words + _U(1)) & _MASK).astype(np.int32), first
    row = row_of(first)
    inner = row[1:] == row[:-1]
    pairs = mix((words[1:] - words[:-1])[inner] + _U(2)) & _MASK
    yield pairs.astype(np.int32), np.concatenate([[0], np.cumsum(np.maximum(np.diff(first) - 1, 0))])
    chars = np.flatnonzero(texts.char_starts())
    begin = np.searchsorted(chars, texts.off)
    edge = np.append(chars, len(texts.buf))
    last = np.repeat(begin[1:], np.diff(begin))
    for size in CHAR_GRAMS:
        at = np.flatnonzero(np.arange(len(chars)) + size <= last)
        grams = mix(span_hashes(prefix, edge[at], edge[at + size]) + _U(size)) & _MASK
        yield grams.astype(np.int32), np.searchsorted(at, begin)


@dataclass
class Model:
    """Folded model: the log-odds that each bucket's vector adds, and the bias."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: Texts) -> np.ndarray:
        total, count = np.zeros(texts.n), np.zeros(texts.n, np.int64)
        for buckets, first in feature_groups(texts):
            sums = np.zeros(len(buckets) + 1)
            np.cumsum(self.weights[buckets], dtype=float, out=sums[1:])
            total += sums[first[1:]] - sums[first[:-1]]
            count += np.diff(first)
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -30, 30)))

    def to_bytes(self) -> bytes:
        return json.dumps({"bias": self.bias}).encode() + b"\n" + self.weights.astype("<f4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Model:
        head, _, rest = data.partition(b"\n")
        return cls(np.frombuffer(rest, "<f4"), json.loads(head)["bias"])


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text and the share of its features that falls into each."""
    groups = feature_groups(Texts.of([text]))
    found, counts = np.unique(np.concatenate([b for b, _ in groups]), return_counts=True)
    return found.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """Train on the given documents (each a ``bag``); the order of the rows does not
    matter when they are sorted by the caller."""
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), 0.0)
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    share = np.bincount(labels, minlength=2) / len(labels)
    steps, step = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            rate = 1 - step / steps
            step += 1
            found, part = bags[i]
            mean = part @ vectors[found]
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            grad = p / p.sum()
            grad[labels[i]] -= 1
            grad *= rate * 0.5 / share[labels[i]]  # both classes weigh the same
            back = layer.T @ grad
            layer -= LAYER_RATE * np.outer(grad, mean)
            bias -= LAYER_RATE * 0.1 * grad
            vectors[found] -= VECTOR_RATE * part[:, None] * back
    return Model(vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0]))


def sample_bar(n: int) -> int:
    """The greatest 63-bit hash that is sampled of a class of ``n`` documents: the
    expected sample is SAMPLE_PER_CLASS whatever ``n`` is, or all when they are fewer."""
    return min(1 << 63, (SAMPLE_PER_CLASS << 63) // n) - 1


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``label``: at most about SAMPLE_PER_CLASS documents of
    each class, chosen by a hash of ``doc_id`` up to a bar set from the class counts."""
    clean = (labels.filter("doc_id is not null and label in (0, 1)").groupBy("doc_id")
             .agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").drop("other"))
    sizes = {r["label"]: r["count"] for r in clean.groupBy("label").count().collect()}  # two rows
    bar = F.lit(-1)
    for label, n in sizes.items():
        bar = F.when(F.col("label") == label, F.lit(sample_bar(n))).otherwise(bar)
    chosen = clean.filter(F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 63) - 1)) <= bar)
    # the sample's ids are bounded by twice SAMPLE_PER_CLASS (about), so they are broadcast and texts stay in place;
    # of rows that repeat an id, each task keeps one before anything moves
    text = F.left(text_or_empty(), F.lit(SAMPLE_CHARS))
    rows = docs.select("doc_id", text.alias("text")).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of ``labels`` (``doc_id``, ``label`` 0 or 1) on ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:  # texts are dropped batch by batch; what stays are their features
            rows += [(b.column("doc_id")[i].as_py(), b.column("label")[i].as_py(), bag(b.column("text")[i].as_py())) for i in range(b.num_rows)]
        rows.sort(key=lambda row: row[0])
        model = fit([found for _, _, found in rows], np.array([label for _, label, _ in rows], np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([model.to_bytes()], pa.binary())], ["model"])

    sample = training_sample(docs, labels).select("doc_id", F.col("label").cast("int").alias("label"), "text")
    # the sample is bounded, so one task may hold it; the folded model is 1 MB
    trained = sample.repartition(1).mapInArrow(lean(run), "model binary").first()
    return Model.from_bytes(trained["model"]) if trained else fit([], np.zeros(0, np.int64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1."""
    packed = docs.sparkSession.sparkContext.broadcast(model.to_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Model.from_bytes(packed.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(held.scores(Texts(batch.column("text"))))],
                                             [*batch.schema.names, "score"])

    return docs.mapInArrow(lean(run), StructType([*docs.schema.fields, StructField("score", DoubleType())]))


def held_out(doc_id: str = "doc_id"):
    """Rows that are never learned from: CRC-32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def quality_model(docs: DataFrame, labels: DataFrame) -> Model:
    return train(docs, labels.filter(~held_out()).select("doc_id", F.col("quality").alias("label")))


def accepted_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with a score of at least 0.5, with their own columns."""
    packed = docs.sparkSession.sparkContext.broadcast(model.to_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Model.from_bytes(packed.value)
        for batch in slices(batches):
            yield batch.filter(pa.array(held.scores(Texts(batch.column("text"))) >= 0.5))

    return docs.mapInArrow(lean(run), docs.schema)


def op6_subword_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs.select("doc_id", "text"), quality_model(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
