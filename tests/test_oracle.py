"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

from scripts.check_oracle import digest
from tests.conftest import SF_SMALL
import __spark_entry__ as E
from touchline.fixtures import TABLES
from touchline.plans.catalog import QUERIES

KEYS = sorted(QUERIES)  # the training-data queries have their own tests


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:  # rows-only keys
        assert key == "list_tables" and len(rows) > 0
        return
    res = duck.execute(sql)
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    expect = res.fetchall()
    assert len(rows) == len(expect)
    assert digest(df.columns, rows)[0] == digest(cols, expect)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "form_trend" in df.columns
