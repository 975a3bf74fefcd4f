"""Stored team form: a refresh equals a full build and leaves other ranges alone; reports open few files."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from tests.helpers import MATCH_SCHEMA, match, matches_df
from touchline import fixtures as fx
from touchline.operators.form import build_team_form
from touchline.operators.form_store import read_form, read_ranges, read_teams, refresh_form, replaced_matches, store_form
from touchline.operators.reports import form_series, latest_form, recent_form
from touchline.session import scratch_dir


def same(a, b):
    assert a.columns == b.columns and a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def files(path):
    path = f"{path}/rows".removeprefix("file:")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def changed_ranges(before, after):
    return {f.split("bucket=")[1].split("/")[0] for f in set(before) ^ set(after)}


@pytest.mark.parametrize("buckets", [1, 7, 40])
@pytest.mark.parametrize("strict,keep_unscored", [(False, True), (True, False)])
def test_refresh_equals_full_build(spark, buckets, strict, keep_unscored):
    before, removed, added = fx.matches_before(spark, SF_SMALL)
    path = scratch_dir(spark, "t-form")
    store_form(before, path, strict=strict, keep_unscored=keep_unscored, buckets=buckets)
    same(read_form(spark, path), build_team_form(before, strict=strict, keep_unscored=keep_unscored))
    refresh_form(spark, path, removed, added)
    full = build_team_form(fx.matches(spark, SF_SMALL), strict=strict, keep_unscored=keep_unscored)
    same(read_form(spark, path), full)
    refresh_form(spark, path, removed, added)  # repeated: nothing changes
    same(read_form(spark, path), full)
    counts = read_ranges(spark, path).groupBy("team_name", "team_id", "bucket").count()
    assert counts.exceptAll(read_teams(spark, path)).isEmpty() and counts.count() == read_teams(spark, path).count()


def test_one_late_match_touches_its_ranges_only(spark):
    m = fx.matches(spark, SF_MID)
    path = scratch_dir(spark, "t-form")
    store_form(m, path, buckets=60)
    before = files(path)
    late = m.filter("status = 'finished'").orderBy("match_id").limit(1).withColumn("match_id", F.lit("late")).withColumn(
        "utc_date", F.lit("1995-01-01 12:00:00").cast("timestamp_ntz"))
    none = m.limit(0)
    reached = refresh_form(spark, path, none, late)
    assert 1 <= len(reached) <= 4 and changed_ranges(before, files(path)) == {str(r) for r in reached}
    same(read_form(spark, path), build_team_form(m.unionByName(late), keep_unscored=True))
    # deleted again
    refresh_form(spark, path, late, none)
    same(read_form(spark, path), build_team_form(m, keep_unscored=True))
    assert refresh_form(spark, path, none, none) == []


def test_changes_reach_over_small_ranges(spark):
    """One team in ranges of two or three rows: a change reaches nine rows on, over several of them."""
    day = datetime(2024, 1, 1)
    rows = [list(match(100 + i, 1, "1", str(2 + i % 3), i % 4, i % 3)) for i in range(60)]
    for i, r in enumerate(rows):
        r[2] = day + timedelta(days=i)
    rows[20][2] = rows[21][2]  # a tie in time
    old = matches_df(spark, [tuple(r) for r in rows])
    for at in (0, 20, 59):
        path = scratch_dir(spark, "t-form")
        store_form(old, path, buckets=45)
        corrected = [list(r) for r in rows]
        corrected[at][9] = corrected[at][9] + 5
        removed, added = matches_df(spark, [tuple(rows[at])]), matches_df(spark, [tuple(corrected[at])])
        refresh_form(spark, path, removed, added)
        same(read_form(spark, path), build_team_form(matches_df(spark, [tuple(r) for r in corrected]), keep_unscored=True))
        refresh_form(spark, path, added, spark.createDataFrame([], MATCH_SCHEMA))
        left = [tuple(r) for i, r in enumerate(rows) if i != at]
        same(read_form(spark, path), build_team_form(matches_df(spark, left), keep_unscored=True))
    # all rows of every range go
    refresh_form(spark, path, old, spark.createDataFrame([], MATCH_SCHEMA))
    assert read_form(spark, path).isEmpty()


def test_unknown_teams_and_times(spark):
    rows = [match(i, i % 28 + 1, None if i % 3 == 0 else "7", "8", i % 4, 1) for i in range(40)]
    rows = [(*r[:2], None, *r[3:]) if i % 5 == 0 else r for i, r in enumerate(rows)]
    m = matches_df(spark, rows)
    path = scratch_dir(spark, "t-form")
    store_form(m, path, buckets=9)
    same(read_form(spark, path), build_team_form(m, keep_unscored=True))
    gone = m.filter("match_id in ('0', '6', '15')")
    refresh_form(spark, path, gone, gone.withColumn("home_score", F.lit(9)))
    after = m.withColumn("home_score", F.when(F.col("match_id").isin("0", "6", "15"), 9).otherwise(F.col("home_score")))
    same(read_form(spark, path), build_team_form(after, keep_unscored=True))


def test_replaced_matches(spark):
    m = fx.matches(spark, SF_SMALL)
    new = m.filter("match_id like '1%'").unionByName(m.limit(1).withColumn("match_id", F.lit("new")))
    assert replaced_matches(m, new).count() == new.count() - 1


def opened(df):
    """How many files (one for each range) the scans of a read opened."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = df.select("*")
        rows.collect()
        leaves = rows._jdf.queryExecution().executedPlan().collectLeaves()
        found = [leaves.apply(i).metrics().get("numFiles") for i in range(leaves.size())]
        return sum(m.get().value() for m in found if m.isDefined())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_reports_open_few_ranges(spark):
    m = fx.matches(spark, SF_MID)
    # a third of the rows has one team
    k = F.col("match_id").cast("bigint")
    m = m.withColumn("home_team_id", F.when(k % 3 != 0, "0").otherwise(F.col("home_team_id"))).withColumn(
        "home_team_name", F.when(k % 3 != 0, "Team 0").otherwise(F.col("home_team_name")))
    m = m.filter("home_team_id <> away_team_id")
    path = scratch_dir(spark, "t-form")
    store_form(m, path, buckets=60)
    plain = build_team_form(m, keep_unscored=True).cache()
    assert len(files(path)) >= 50
    for team, exact, most in (("Team 0", True, 2), ("Team 7", True, 2), ("team 1", False, 24)):
        stored = read_form(spark, path, team, exact=exact, newest=20)
        assert 1 <= opened(stored) <= most
        same(recent_form(stored, team, exact=exact), recent_form(plain, team, exact=exact))
    assert opened(read_form(spark, path, "Team 0", exact=True)) >= 15  # all of them without a bound
    same(form_series(read_form(spark, path, "Team 0", exact=True, newest=20), "Team 0"), form_series(plain, "Team 0"))
    newest = read_form(spark, path, newest=1)
    assert opened(newest) <= 25
    same(latest_form(newest), latest_form(plain))
    assert read_form(spark, path, "nobody", newest=20).isEmpty()

