"""Edge rows (FIXTURES.md section 4): one test per decided behaviour."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from tests.helpers import match, matches_df
from touchline.operators.dedup import keep_latest
from touchline.operators.flatten import flatten_flat, flatten_nested, flatten_standings
from touchline.operators.form import build_team_form
from touchline.operators.quality import add_quality_flag, check_gold, check_silver, run_checks, unique
from touchline.operators.results import match_results
from touchline.operators.rivalry import head_to_head, pair_matches
from touchline.operators.standings import league_standings
from touchline.schemas import FLAT_MATCH, NESTED_MATCH, RAW_MATCH, STANDINGS_DOC
from touchline.session import scratch_dir
from touchline.sources.messages import parse_messages
from touchline.sources.raw import read_raw


def test_unscored_finished_dropped_or_kept(spark):
    m = matches_df(spark, [match(1, 1, "1", "2", None, None)])
    assert build_team_form(m, keep_unscored=False).count() == 0
    kept = build_team_form(m, keep_unscored=True).collect()
    assert {(r.result, r.points) for r in kept} == {("L", 0)}
    assert match_results(m, keep_unscored=True).first().result == "draw"
    assert match_results(m, keep_unscored=False).count() == 0


def test_half_scored_keeps_one_side(spark):
    m = matches_df(spark, [match(1, 1, "1", "2", None, 2)])
    rows = build_team_form(m, strict=True, keep_unscored=False).collect()
    assert len(rows) == 1 and rows[0].team_id == "2" and rows[0].result == "L"


def test_trend_tie_default_vs_strict(spark):
    # ten draws for team 1: points_last5 is 5 at rows 5..10, equal to 5 rows earlier
    rows = [match(i, i, "1", "2", 1, 1) for i in range(1, 11)]
    m = matches_df(spark, rows)
    last = F.col("match_id") == "10"
    default = build_team_form(m).filter(last & (F.col("team_id") == "1")).first()
    strict = build_team_form(m, strict=True).filter(last & (F.col("team_id") == "1")).first()
    assert default.points_last5 == 5 and default.form_trend == "improving"
    assert strict.form_trend == "declining"


def test_first_five_matches_partial_frames(spark):
    rows = [match(i, i, "1", "2", i % 3, 0) for i in range(1, 6)]
    out = (build_team_form(matches_df(spark, rows)).filter(F.col("team_id") == "1")
           .orderBy("utc_date").collect())
    assert [r.form_trend for r in out] == ["improving"] * 5
    goals = [i % 3 for i in range(1, 6)]
    assert out[1].goals_scored_rolling_avg_5 == round(sum(goals[:2]) / 2, 2)
    assert out[4].points_last5 == sum(3 if g > 0 else 1 for g in goals)


def test_same_key_same_time_is_deterministic(spark):
    ts = datetime(2024, 1, 1)
    df = spark.createDataFrame([("1", ts, "b"), ("1", ts, "a"), ("1", ts, None)],
                               "match_id string, ingested_at timestamp_ntz, status string")
    for _ in range(3):
        assert keep_latest(df.repartition(3), ["match_id"], ["ingested_at"]).first().status == "a"


def test_null_match_ids_collapse_to_one_incomplete(spark):
    ts = datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(None, "1", "2", ts, "finished", ts)] * 3,
        "match_id string, home_team_id string, away_team_id string, utc_date timestamp_ntz, "
        "status string, ingested_at timestamp_ntz")
    out = keep_latest(add_quality_flag(df), ["match_id"], ["ingested_at"]).collect()
    assert len(out) == 1 and out[0].quality_flag == "incomplete"


def _flat(spark, **kw):
    base = {f.name: None for f in FLAT_MATCH.fields if f.name != "_metadata"}
    base.update(idEvent="9", idHomeTeam="1", idAwayTeam="2", strStatus="Match Finished")
    base.update(kw)
    row = tuple(base[f.name] for f in FLAT_MATCH.fields if f.name != "_metadata") + (None,)
    return flatten_flat(spark.createDataFrame([row], FLAT_MATCH)).first()


def test_flat_time_and_date_rules(spark):
    assert _flat(spark, dateEvent="2024-08-16", strTime=None).utc_date == datetime(2024, 8, 16)
    assert _flat(spark, dateEvent="2024-08-16", strTime="19:30:00").utc_date == datetime(2024, 8, 16, 19, 30)
    assert _flat(spark, dateEvent=None, strTime="19:30:00").utc_date is None
    assert _flat(spark, intHomeScore="x").home_score is None


def test_status_normalisation(spark):
    got = {s: _flat(spark, strStatus=s).status
           for s in ("Match Finished", "Not Started", "Match Postponed", "1H")}
    assert got == {"Match Finished": "finished", "Not Started": "scheduled",
                   "Match Postponed": "postponed", "1H": "1h"}


def test_batch_without_metadata(spark):
    path = scratch_dir(spark, "nometa")
    day = f"{path}/date=2024-01-01"
    import os
    os.makedirs(day, exist_ok=True)
    with open(f"{day}/batch.json", "w") as fh:
        json.dump([{"id": 5, "utcDate": "2024-08-16T19:00:00Z", "status": "FINISHED",
                    "homeTeam": {"id": 1, "name": "A"}, "awayTeam": {"id": 2, "name": "B"}}], fh)
    raw = read_raw(spark, path, RAW_MATCH, multi_line=True)
    row = flatten_nested(raw.drop("date")).first()
    assert row.match_id == "5" and row.ingested_at is None and row.competition_id == "PL"
    assert str(raw.select("date").first().date) == "2024-01-01"


def test_names_with_wildcards_match_literally(spark):
    m = matches_df(spark, [match(1, 1, "1", "2", 1, 0, hn="O'Neil 100%", an="A_B"),
                           match(2, 2, "3", "4", 1, 0, hn="O'Neil 1000", an="AxB")])
    res = match_results(m)
    assert pair_matches(res, "o'neil 100%", "a_b").count() == 1


def test_pair_order_is_by_string_id(spark):
    m = matches_df(spark, [match(1, 1, "6", "57", 2, 1)])
    r = head_to_head(match_results(m, keep_unscored=False)).first()
    assert (r.team_a_id, r.team_b_id, r.team_b_wins) == ("57", "6", 1)


def test_renamed_team_breaks_unique(spark):
    m = matches_df(spark, [match(1, 1, "1", "2", 1, 0, hn="Old"), match(2, 2, "1", "2", 1, 0, hn="New")])
    st = league_standings(build_team_form(m, strict=True))
    assert st.filter(F.col("team_id") == "1").count() == 2
    chk = run_checks(st, "gold_league_standings", [unique("team_id")]).first()
    assert chk.violations == 1 and chk.passed is False


def test_standings_only_total_rows_and_empty_tables(spark):
    row = {"team": {"id": 7, "name": "T"}, "position": 1}
    docs = spark.createDataFrame([
        ({"standings": [{"type": "HOME", "table": [row]}, {"type": "TOTAL", "table": [row]},
                        {"type": "AWAY", "table": [row]}], "_metadata": None},),
        ({"standings": [{"type": "TOTAL", "table": []}], "_metadata": None},),
    ], f"d {STANDINGS_DOC.simpleString()}").select("d.*")
    out = flatten_standings(docs).collect()
    assert len(out) == 1 and out[0].team_id == "7"


def test_malformed_and_bare_messages(spark):
    df = spark.createDataFrame([("t", "1", "{bad"), ("t", "2", "5"), ("t", "3", '{"a": 1}')],
                               "topic string, key string, value string")
    assert sorted(r.key for r in parse_messages(df).collect()) == ["2", "3"]


def test_empty_tables_do_not_pass(spark):
    empty_m = matches_df(spark, [])
    assert check_silver(empty_m).first().passed is False
    empty_f = build_team_form(empty_m)
    assert check_gold(empty_f).first().passed is False


def test_nested_schema_round_trip_keeps_nulls(spark):
    df = spark.createDataFrame([], NESTED_MATCH)
    assert flatten_nested(df).columns[0] == "match_id"
