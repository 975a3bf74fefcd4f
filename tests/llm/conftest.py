import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edge_rows import EDGES, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def real(spark):
    """The whole documents table of the smallest size, and its rows by id."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, {r["doc_id"]: r["text"] for r in docs.collect()}
