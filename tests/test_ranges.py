"""Ranges are found by compiled steps."""

from bisect import bisect_right
from datetime import datetime

import pytest
from touchline.operators.windows import BUCKET, range_rows, sample_bounds

SCHEMA = "team string, at timestamp_ntz, id int"


def _rows(n):
    """Few distinct keys, many of them NULL in part."""
    return [(None if i % 7 == 0 else f"t{i % 5}", None if i % 11 == 0 else datetime(2024, 1, 1 + i % 9), i % 13) for i in range(n)]


def _order(row):
    return tuple((v is not None, v) if v is not None else (False,) for v in row)


@pytest.mark.parametrize("n,buckets", [(0, 4), (1, 4), (40, 1), (40, 2), (200, 9), (200, 64), (300, 150)])
def test_bucket_is_the_number_of_bounds_at_or_below(spark, n, buckets):
    df = spark.createDataFrame(_rows(n), SCHEMA)
    keys = ("team", "at", "id")
    bounds = sample_bounds(df, keys, buckets)
    ranged = range_rows(df, keys[:1], keys[1:], bounds=bounds)
    held = [_order(b) for b in bounds]
    assert held == sorted(held)
    got = ranged.rows.collect()
    assert len(got) == n and all(r[BUCKET] == bisect_right(held, _order(r[:3])) for r in got)
    assert [tuple(r) for r in ranged.bounds_table().orderBy(BUCKET).collect()] == [(i + 1, *b) for i, b in enumerate(bounds)]


def test_ranges_are_not_searched_by_interpreted_functions(spark):
    df = spark.createDataFrame(_rows(300), SCHEMA)
    rows = range_rows(df, ["team"], ["at", "id"], buckets=50).rows
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "cast([[" not in plan
