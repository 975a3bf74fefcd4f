"""Landing, streams, snapshots and the composed runs (file sources only)."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from touchline import fixtures as fx
from touchline.operators.snapshots import (
    read_ledger,
    compare_latest,
    read_as_of,
    read_at,
    snapshot_history,
    snapshot_report,
    write_snapshot,
)
from touchline.plans.catalog import QUERIES
from touchline.plans.pipelines import LakeConfig, run_full, run_live
from touchline.operators.reports import has_fresh_files
from touchline.functions.expressions import parse_utc
from touchline.session import scratch_dir
from touchline.sources.messages import to_messages
from touchline.sources.raw import stamp_metadata
from touchline.streaming.land import land_raw, read_landed, read_topics


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_landing_restart_adds_nothing(spark):
    root = scratch_dir(spark, "t-land")
    msgs = fx.event_messages(spark, SF_SMALL)
    msgs.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(f"{root}/in")
    for _ in range(2):
        land_raw(read_topics(spark, f"{root}/in"), f"{root}/bronze", f"{root}/ckpt").awaitTermination()
    landed = read_landed(spark, f"{root}/bronze")
    valid = msgs.filter(F.try_parse_json("value").isNotNull())
    assert landed.count() == valid.count()
    assert landed.filter(F.col("value").endswith("}") | F.col("value").rlike("^[0-9]+$")).count() == landed.count()
    assert {r.kind for r in landed.select("kind").distinct().collect()} == {"matches", "standings", "other"}
    assert has_fresh_files(spark, f"{root}/bronze", datetime.now() - timedelta(minutes=10))
    assert not has_fresh_files(spark, f"{root}/bronze", datetime.now() + timedelta(minutes=10))


def test_stream_upsert_equals_batch(spark):
    a = QUERIES["stream_upsert"](spark, SF_SMALL)
    b = QUERIES["keep_latest"](spark, SF_SMALL)
    assert a.count() == b.count() and a.exceptAll(b).isEmpty()


def test_snapshots_ledger_and_pruning(spark):
    path = scratch_dir(spark, "t-snap")
    m = fx.matches(spark, SF_SMALL)
    first = m.filter(F.year("utc_date") <= 1996)
    n1 = write_snapshot(first, path, "silver.matches", 1, datetime(2024, 1, 1))
    n2 = write_snapshot(m, path, "silver.matches", 2, datetime(2024, 2, 1))
    assert (n1, n2) == (first.count(), m.count())
    hist = snapshot_history(spark, path).collect()
    assert [r.snapshot_id for r in hist] == [2, 1]
    assert [r.operation for r in hist] == ["overwrite", "append"]
    assert hist[0].total_records == str(n2)
    at1 = read_at(spark, path, 1)
    assert at1.count() == n1 and {f.split("snapshot_id=")[1].split("/")[0] for f in at1.inputFiles()} == {"1"}
    assert read_as_of(spark, path, "2024-01-15 00:00:00").count() == n1
    assert read_at(spark, path, 3).count() == 0  # not in the ledger
    cmp = compare_latest(spark, path).first()
    assert (cmp.newest_count, cmp.previous_count, cmp.row_delta) == (n2, n1, n2 - n1)
    assert "/data" not in _plan(compare_latest(spark, path))  # counts of the ledger
    report = snapshot_report(spark, [("silver.matches", path)])
    assert {r.snapshot_id: r.rows_at_snapshot for r in report.collect()} == {1: n1, 2: n2}
    scan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert scan.count("ReadSchema: struct<>") == 1


def test_messages_key_fallback(spark):
    df = spark.createDataFrame([(1, None), (None, "e7"), (None, None)], "id bigint, idEvent string")
    keys = sorted(r.key for r in to_messages(df, "t").collect())
    assert keys == ["1", "e7", "unknown"]
    stamped = stamp_metadata(df, "src", "PL", "2024-01-01T00:00:00+00:00")
    assert stamped.select("_metadata.source").first()[0] == "src"


def test_run_live_and_full(spark):
    root = scratch_dir(spark, "t-live")
    payloads = fx.nested_payload(fx.match_versions(spark, SF_SMALL))
    msgs = to_messages(payloads, "x-matches").withColumn("timestamp", F.lit(datetime(2024, 1, 13)))
    msgs.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(f"{root}/in")
    out = run_live(spark, LakeConfig(root), f"{root}/in", since=datetime.now()).first()
    assert out.total_rows == payloads.select("id").distinct().count() and out.passed
    # the backfill reads what the landing wrote; a rerun and an empty lake change nothing
    full = run_full(spark, LakeConfig(root), datetime(2024, 1, 15, 12))
    # payloads without a home team (every 13th) are the only violations
    failed = {(r.model, r.column_name, r.check) for r in full.filter("not passed").collect()}
    assert failed == {("gold_team_form", "team_id", "not_null"), ("gold_league_standings", "team_id", "not_null")}
    again = run_full(spark, LakeConfig(root), datetime(2024, 1, 15, 12))
    assert again.count() == full.count()
    assert read_ledger(spark, f"{root}/silver/matches").groupBy("snapshot_id").count().filter("count > 1").isEmpty()
    assert run_full(spark, LakeConfig(f"{root}/none"), datetime(2024, 1, 15)).isEmpty()
    report = QUERIES["run_full"](spark, SF_SMALL).collect()
    by = {(r.model, r.column_name, r.check): r for r in report}
    assert by[("silver_matches", "*", "validate_silver")].passed
    assert by[("team_form", "*", "validate_gold")].passed
    assert by[("gold_team_form", "goals_scored", "not_null")].passed  # the model drops unscored
    assert by[("gold_match_results", "match_id", "unique")].passed
    assert os.path.isdir(f"{root}/bronze")


def test_parse_messages_counts_drops(spark):
    from pyspark.sql import Observation
    from touchline.sources.messages import parse_messages
    obs = Observation("msgs")
    df = spark.createDataFrame([("t", "1", "{bad"), ("t", "2", "5"), ("t", "3", "{")],
                               "topic string, key string, value string")
    assert parse_messages(df, observation=obs).count() == 1
    assert obs.get == {"received": 3, "dropped": 2}


def test_valid_only_skips_incomplete(spark):
    from tests.helpers import match, matches_df
    from touchline.operators.form import build_team_form
    from touchline.operators.quality import add_quality_flag
    m = add_quality_flag(matches_df(spark, [match(1, 1, "1", "2", 1, 0), match(2, 2, None, "2", 1, 0)]))
    assert build_team_form(m, valid_only=True).count() == 2
    assert build_team_form(m).count() == 4


def test_first_snapshot_is_append_without_failed_reads(spark):
    from touchline.operators.snapshots import read_ledger
    from touchline.sources.tables import path_exists
    root = scratch_dir(spark, "t-first")
    assert not path_exists(spark, root)
    df = fx.matches(spark, SF_SMALL)
    for sid in (1, 2):
        write_snapshot(df, root, "silver.matches", sid, datetime(2024, 1, sid))
    assert path_exists(spark, f"{root}/ledger")
    ops = {r.snapshot_id: r.operation for r in read_ledger(spark, root).collect()}
    assert ops == {1: "append", 2: "overwrite"}


def test_payload_with_line_breaks_lands_as_one_row(spark):
    root = scratch_dir(spark, "t-lines")
    rows = [("k", '{\n "id": "text-id",\r\n "dateEvent": ""\n}', "x-matches", datetime(2024, 1, 13))]
    msgs = spark.createDataFrame(rows, "key string, value string, topic string, timestamp timestamp_ntz")
    msgs.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(f"{root}/in")
    land_raw(read_topics(spark, f"{root}/in"), f"{root}/bronze", f"{root}/ckpt").awaitTermination()
    landed = read_landed(spark, f"{root}/bronze").collect()
    assert len(landed) == 1 and "text-id" in landed[0]["value"]


def test_text_without_a_date_is_null(spark):
    got = spark.createDataFrame([("",), (" 19:30",), ("2024-01-13T10:00:00Z",), ("2024-01-13",)], "t string").select(parse_utc("t").alias("t")).collect()
    assert [r["t"] is None for r in got] == [True, True, False, False]
