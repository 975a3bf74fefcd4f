"""A training corpus from raw documents: filter, filter, deduplicate, clean, pack.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)`` and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``documents``.  ``run`` applies them to
the ``documents`` table.  The stages' edge cases are those of their operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import classifier, nearduplicates, packing, repetition, substrings
from touchline.llm.common import ship_package, table, write_scratch
from touchline.llm.tokenizer_files import vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the table's labels, takes for good ones."""
    labels = table(spark, sf_dir, "labels")
    return classifier.accepted_documents(docs, classifier.quality_model(docs, labels))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are long enough and do not repeat themselves too much."""
    ship_package(spark)
    return repetition.filter_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    ship_package(spark)
    return nearduplicates.deduplicate(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand in another document or earlier in the same."""
    ship_package(spark)
    return substrings.deduplicate(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences of 4096."""
    ship_package(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packed_sequences),
]

#: SQL cannot train a classifier or tokenize; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
