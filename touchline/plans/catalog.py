"""The registered queries: one per operator key of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame computed from the test
tables (through the fixture projections in ``touchline.fixtures``).  Keys that
exercise files (bronze landing, streams, snapshots, catalog) write to a fresh
folder under the shared checkpoint directory first and return a lazy read of
what was written.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import fixtures as fx
from touchline.functions.expressions import epoch_ms_to_ts, normalize_status
from touchline.operators.dedup import keep_latest
from touchline.operators.flatten import flatten_flat, flatten_matches, flatten_nested, flatten_standings
from touchline.operators.form import add_result_points, build_team_form, finished, to_perspectives
from touchline.operators.form_store import read_form, refresh_form, store_form
from touchline.operators.quality import (
    FORM_RESULTS,
    FORM_TRENDS,
    GOLD_NOT_NULL,
    MATCH_RESULTS,
    accepted,
    add_quality_flag,
    at_least,
    between,
    check_gold,
    check_silver,
    not_null,
    run_checks,
    unique,
    violations,
)
from touchline.operators.quarantine import match_rules, read_quarantine, write_quarantine
from touchline.operators.reports import (
    date_window,
    form_series,
    fresh_rows,
    latest_form,
    recent_form,
    top_team_form,
    top_two_history,
)
from touchline.operators.results import match_results
from touchline.operators.rivalry import head_to_head, pair_matches, pair_matches_exact, pair_tally
from touchline.operators.setops import team_names, teams
from touchline.operators.snapshots import (
    compare_latest,
    read_as_of,
    read_at,
    read_ledger,
    snapshot_history,
    snapshot_report,
)
from touchline.operators.standings import dashboard_standings, league_kpis, league_standings, standings_by_name
from touchline.operators.totals import (
    change_totals,
    kept_head_to_head,
    kept_standings,
    kept_standings_by_name,
    pair_totals,
    read_totals,
    store_totals,
    team_totals,
)
from touchline.plans.pipelines import (
    LakeConfig,
    build_silver_matches,
    build_silver_standings,
    full_run,
    gold_models,
)
from touchline.schemas import PAYLOAD_META, RAW_MATCH, STANDINGS_DOC
from touchline.session import ensure_utc, scratch_dir
from touchline.sources.messages import COMPETITION_KEY, parse_messages, to_messages
from touchline.sources.raw import read_raw, write_raw
from touchline.sources.tables import ensure_namespaces, list_tables, materialize
from touchline.streaming.land import land_raw, read_landed, read_topics
from touchline.streaming.upsert import read_latest, upsert_stream

Query = Callable[[SparkSession, str], DataFrame]

# Fixed report parameters (what a user would pick in the reports).
TEAM = "Team 1"
PAIR_FUZZY = ("Team 1", "Team 2")
PAIR_EXACT = ("Team 0", "Team 1")
AS_OF = "1998-06-30 00:00:00"
LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]
LINEITEM_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


# ---------------------------------------------------------------- inputs

def _m(spark, sf):
    ensure_utc(spark)
    return fx.matches(spark, sf)


def _form(spark, sf, strict=False, keep_unscored=False):
    return build_team_form(_m(spark, sf), strict=strict, keep_unscored=keep_unscored)


def _gold_form(spark, sf):
    """The DataFrame builder's team form (the table the reports read)."""
    return _form(spark, sf, strict=False, keep_unscored=True)


def _form_rows(spark, sf, keep_unscored):
    """The rows of a team-form table without its window columns: enough for
    anything that only aggregates them (standings, KPIs, names)."""
    return add_result_points(to_perspectives(finished(_m(spark, sf)), keep_unscored=keep_unscored))


_STORED: dict[tuple[str, str], str] = {}


def _stored_form(spark, sf):
    """Path of the team form that the reports read: written once for a session and
    its tables, as a gold table is."""
    of = (spark.sparkContext.applicationId, sf)
    if of not in _STORED:
        path = scratch_dir(spark, "gold-form")
        store_form(_m(spark, sf), path)
        _STORED[of] = path
    return _STORED[of]


def _gold_results(spark, sf):
    return match_results(_m(spark, sf), keep_unscored=True)


def _versions(spark, sf):
    ensure_utc(spark)
    return fx.match_versions(spark, sf)


def _unified(spark, sf):
    ensure_utc(spark)
    return flatten_matches(fx.raw_matches(spark, sf))


def _bronze(spark, sf, kind):
    """Land the derived raw payloads of one kind as JSON lines by ingest day."""
    ensure_utc(spark)
    path = scratch_dir(spark, f"bronze-{kind}")
    rows = fx.raw_matches(spark, sf, with_date=True) if kind == "matches" \
        else fx.standings_docs(spark, sf, with_date=True)
    write_raw(rows, path)
    return path


# ---------------------------------------------------------------- gold

def q_team_form(spark, sf):
    return _form(spark, sf, strict=False, keep_unscored=False)


def q_team_form_strict(spark, sf):
    return _form(spark, sf, strict=True, keep_unscored=False)


def q_team_form_unscored(spark, sf):
    return _gold_form(spark, sf)


def q_form_refresh(spark, sf):
    """The form of an earlier state, refreshed by late, corrected and deleted
    matches: the rows of a full build."""
    ensure_utc(spark)
    before, removed, added = fx.matches_before(spark, sf)
    path = scratch_dir(spark, "form")
    store_form(before, path)
    refresh_form(spark, path, removed, added)
    return read_form(spark, path)


def q_perspectives(spark, sf):
    return add_result_points(to_perspectives(finished(_m(spark, sf)), keep_unscored=True))


def q_match_results(spark, sf):
    return _gold_results(spark, sf)


def q_match_results_strict(spark, sf):
    return match_results(_m(spark, sf), keep_unscored=False)


def q_head_to_head(spark, sf):
    return head_to_head(match_results(_m(spark, sf), keep_unscored=False))


def q_league_standings(spark, sf):
    return league_standings(_form_rows(spark, sf, keep_unscored=False))


def q_league_standings_by_name(spark, sf):
    return standings_by_name(_form_rows(spark, sf, keep_unscored=True))


def q_dashboard_standings(spark, sf):
    return dashboard_standings(_form_rows(spark, sf, keep_unscored=True))


def _kept(spark, sf, totals):
    """Totals of an earlier state, kept up to date by late, corrected and deleted
    matches, which arrive in two parts."""
    ensure_utc(spark)
    before, removed, added = fx.matches_before(spark, sf)
    path = scratch_dir(spark, "totals")
    store_totals(before, path, totals)
    for part in range(2):
        of_part = F.regexp_extract("match_id", r"^\d+", 0).cast("bigint") % 2 == part
        change_totals(spark, path, totals, str(part), removed.filter(of_part), added.filter(of_part))
    return read_totals(spark, path, totals)


def q_league_standings_kept(spark, sf):
    return kept_standings(_kept(spark, sf, team_totals()))


def q_league_standings_by_name_kept(spark, sf):
    return kept_standings_by_name(_kept(spark, sf, team_totals(("team_name",), keep_unscored=True)))


def q_head_to_head_kept(spark, sf):
    return kept_head_to_head(_kept(spark, sf, pair_totals()))


def q_teams(spark, sf):
    return teams(_m(spark, sf))


def q_team_names(spark, sf):
    return team_names(_form_rows(spark, sf, keep_unscored=True))


# ---------------------------------------------------------------- reports

def q_team_form_recent(spark, sf):
    stored = read_form(spark, _stored_form(spark, sf), TEAM, newest=20)
    return recent_form(stored, team=TEAM, exact=False)


def q_team_form_recent_exact(spark, sf):
    stored = read_form(spark, _stored_form(spark, sf), TEAM, exact=True, newest=20)
    return recent_form(stored, team=TEAM, exact=True)


def q_pair_matches(spark, sf):
    return pair_matches(_gold_results(spark, sf), *PAIR_FUZZY)


def q_pair_matches_exact(spark, sf):
    return pair_matches_exact(_gold_results(spark, sf), *PAIR_EXACT)


def q_pair_tally(spark, sf):
    return pair_tally(_gold_results(spark, sf), *PAIR_EXACT)


def q_league_kpis(spark, sf):
    return league_kpis(_form_rows(spark, sf, keep_unscored=True))


def q_latest_form(spark, sf):
    return latest_form(read_form(spark, _stored_form(spark, sf), newest=1))


def q_top_team_form(spark, sf):
    return top_team_form(read_form(spark, _stored_form(spark, sf)))


def q_top_two_history(spark, sf):
    return top_two_history(_form_rows(spark, sf, keep_unscored=True), _gold_results(spark, sf))


def q_form_series(spark, sf):
    return form_series(read_form(spark, _stored_form(spark, sf), TEAM, exact=True, newest=20), TEAM)


def q_date_window(spark, sf):
    to = datetime.fromisoformat(fx.WINDOW_TO)
    from_ = to - timedelta(days=fx.WINDOW_DAYS)
    return date_window(_m(spark, sf), "utc_date", from_.isoformat(sep=" "), to.isoformat(sep=" "))


def q_fresh_rows(spark, sf):
    ensure_utc(spark)
    e = fx.read_table(spark, sf, "events")
    return fresh_rows(e, "ts", fx.FIXED_NOW, fx.FRESH_MINUTES).select("event_id", "ts", "event_type")


def q_epoch_to_ts(spark, sf):
    ensure_utc(spark)
    e = fx.read_table(spark, sf, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"))
    return e.select("event_id", "timestamp_ms", epoch_ms_to_ts("timestamp_ms").alias("committed_at"))


# ---------------------------------------------------------------- silver

def q_normalize_status(spark, sf):
    p = fx.flat_payload(_versions(spark, sf))
    return p.select(F.col("idEvent").alias("match_id"), F.col("strStatus").alias("raw_status"),
                    normalize_status("strStatus").alias("status"))


def q_flatten_nested(spark, sf):
    return flatten_nested(fx.nested_payload(_versions(spark, sf)))


def q_flatten_flat(spark, sf):
    return flatten_flat(fx.flat_payload(_versions(spark, sf)))


def q_unify_sources(spark, sf):
    return _unified(spark, sf)


def q_unknown_sources(spark, sf):
    """No row has a known source: all are read as the nested shape."""
    unknown = fx.nested_payload(_versions(spark, sf))
    elsewhere = F.col(PAYLOAD_META).withField("source", F.lit("elsewhere"))
    return flatten_matches(unknown.withColumn(PAYLOAD_META, elsewhere))


def q_quality_flag(spark, sf):
    return add_quality_flag(_unified(spark, sf))


def q_raw_roundtrip(spark, sf):
    path = _bronze(spark, sf, "matches")
    raw = read_raw(spark, path, RAW_MATCH)
    return raw.select("date", F.col("_metadata.source").alias("source"),
                      F.coalesce(F.col("id").cast("string"), F.col("idEvent")).alias("match_key"),
                      F.col("_metadata.ingested_at").alias("ingested_at"))


def q_silver_matches(spark, sf):
    path = _bronze(spark, sf, "matches")
    return build_silver_matches(read_raw(spark, path, RAW_MATCH).drop("date"))


def q_keep_latest(spark, sf):
    li = fx.read_table(spark, sf, "lineitem")
    return keep_latest(li, LINEITEM_KEYS, LINEITEM_ORDER)


def _docs_table(spark, sf):
    """Standings documents landed as a Parquet table (a written table in the
    shared folder, as bronze would be), so the scan feeds the generators."""
    ensure_utc(spark)
    path = scratch_dir(spark, "docs")
    docs = fx.standings_docs(spark, sf)
    docs.write.mode("overwrite").parquet(path)
    return spark.read.schema(docs.schema).parquet(path)


def q_flatten_standings(spark, sf):
    return flatten_standings(_docs_table(spark, sf))


def q_keep_latest_standings(spark, sf):
    return keep_latest(flatten_standings(_docs_table(spark, sf)), ["team_id"], ["ingested_at"])


def q_silver_standings(spark, sf):
    path = _bronze(spark, sf, "standings")
    return build_silver_standings(read_raw(spark, path, STANDINGS_DOC).drop("date"))


def q_to_messages(spark, sf):
    """Matches by their id on one topic, standings documents by competition on another."""
    v = _versions(spark, sf)
    standings = to_messages(fx.standings_docs(spark, sf, sent=True), "x-standings", COMPETITION_KEY)
    return (to_messages(fx.nested_payload(v), "x-matches")
            .unionByName(to_messages(fx.flat_payload(v), "x-matches")).unionByName(standings))


def q_parse_messages(spark, sf):
    ensure_utc(spark)
    return parse_messages(fx.event_messages(spark, sf))


# ---------------------------------------------------------------- streaming

def _message_files(spark, sf, path, part=None):
    msgs = fx.event_messages(spark, sf)
    if part is not None:
        msgs = msgs.filter(F.col("key").cast("bigint") % 2 == part)
    (msgs.write.mode("append")
         .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path))


def q_stream_land_raw(spark, sf):
    ensure_utc(spark)
    root = scratch_dir(spark, "land")
    _message_files(spark, sf, f"{root}/in")
    q = land_raw(read_topics(spark, f"{root}/in"), f"{root}/bronze", f"{root}/ckpt")
    q.awaitTermination()
    return read_landed(spark, f"{root}/bronze")


def q_stream_restart(spark, sf):
    """Land half the feed, add the other half, restart twice on the same
    checkpoint: every message lands exactly once."""
    ensure_utc(spark)
    root = scratch_dir(spark, "restart")
    for part in (0, 1, None):
        if part is not None:
            _message_files(spark, sf, f"{root}/in", part)
        q = land_raw(read_topics(spark, f"{root}/in"), f"{root}/bronze", f"{root}/ckpt")
        q.awaitTermination()
    return read_landed(spark, f"{root}/bronze")


def q_stream_land_once(spark, sf):
    """The feed is delivered three times, twice before a restart: every message lands once."""
    ensure_utc(spark)
    root = scratch_dir(spark, "once")
    for times in (2, 1):
        for _ in range(times):
            _message_files(spark, sf, f"{root}/in")
        q = land_raw(read_topics(spark, f"{root}/in"), f"{root}/bronze", f"{root}/ckpt", once_within="1 day")
        q.awaitTermination()
    return read_landed(spark, f"{root}/bronze")


def q_stream_upsert(spark, sf):
    """``lineitem`` arrives in batches that are appended as versions; every second
    one compacts the key ranges that have grown.  The read joins base and deltas."""
    ensure_utc(spark)
    root = scratch_dir(spark, "upsert")
    li = fx.read_table(spark, sf, "lineitem")
    for part in range(3):
        li.filter(F.col("l_orderkey") % 3 == part).write.mode("append").parquet(f"{root}/in")
    # Micro-batch boundaries do not matter: keep-latest is idempotent and order-free.
    stream = spark.readStream.schema(li.schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/in")
    order = [F.col(c).desc_nulls_last() for c in LINEITEM_ORDER]
    q = upsert_stream(stream, f"{root}/table", f"{root}/ckpt", LINEITEM_KEYS, order, compact_every=2)
    q.awaitTermination()
    return read_latest(spark, f"{root}/table", order).select(*li.columns)


# ---------------------------------------------------------------- checks

def q_check_silver(spark, sf):
    ensure_utc(spark)
    return check_silver(fx.dirty_matches(spark, sf))


def _dirty_gold_form(spark, sf):
    return fx.dirty_form(_gold_form(spark, sf))


def q_check_gold(spark, sf):
    return check_gold(_dirty_gold_form(spark, sf))


def q_check_not_null(spark, sf):
    m = _m(spark, sf)
    models = gold_models(m, only=tuple(GOLD_NOT_NULL))
    parts = [run_checks(models[name], name, [not_null(c) for c in cols])
             for name, cols in GOLD_NOT_NULL.items()]
    return reduce(DataFrame.unionByName, parts)


def q_check_unique(spark, sf):
    results_all_versions = match_results(_unified(spark, sf), keep_unscored=True)
    dirty_standings = league_standings(build_team_form(fx.dirty_matches(spark, sf), strict=True))
    return run_checks(results_all_versions, "gold_match_results", [unique("match_id")]).unionByName(
        run_checks(dirty_standings, "gold_league_standings", [unique("team_id")]))


def q_check_accepted(spark, sf):
    form = _dirty_gold_form(spark, sf)
    results = match_results(_m(spark, sf), keep_unscored=False)
    return run_checks(form, "gold_team_form", [accepted("result", FORM_RESULTS),
                                               accepted("form_trend", FORM_TRENDS)]).unionByName(
        run_checks(results, "gold_match_results", [accepted("result", MATCH_RESULTS)]))


def q_check_points_range(spark, sf):
    return violations(_dirty_gold_form(spark, sf), [between("points_last5", 0, 15)],
                      ["team_id", "match_id", "points_last5"])


def q_check_scores(spark, sf):
    ensure_utc(spark)
    results = match_results(fx.dirty_matches(spark, sf), keep_unscored=False)
    return violations(results, [at_least("home_score", 0), at_least("away_score", 0)],
                      ["match_id", "home_score", "away_score"])


# ---------------------------------------------------------------- snapshots

def _standings_by_day(spark, sf):
    return keep_latest(flatten_standings(fx.standings_docs(spark, sf)), ["team_id"], ["ingested_at"])


def _snap(spark, sf, table="silver.matches"):
    path = scratch_dir(spark, "snap-" + table.replace(".", "-"))
    df = {"silver.matches": _m, "gold.team_form": _gold_form, "gold.match_results": _gold_results,
          "silver.standings": _standings_by_day}[table](spark, sf)
    fx.write_yearly_snapshots(df, path, table, "ingested_at" if table == "silver.standings" else "utc_date")
    return path


def q_snapshot_history(spark, sf):
    return snapshot_history(spark, _snap(spark, sf))


def q_read_at_snapshot(spark, sf):
    path = _snap(spark, sf)
    oldest = read_ledger(spark, path).agg(F.min("snapshot_id")).first()[0]
    return read_at(spark, path, oldest)


def q_snapshot_compare(spark, sf):
    return compare_latest(spark, _snap(spark, sf))


def q_read_as_of(spark, sf):
    return read_as_of(spark, _snap(spark, sf), AS_OF)


def q_snapshot_report(spark, sf):
    tables = ["silver.matches", "silver.standings", "gold.team_form", "gold.match_results"]
    return snapshot_report(spark, [(t, _snap(spark, sf, t)) for t in tables])


# ---------------------------------------------------------------- catalog, pipelines

def q_list_tables(spark, sf):
    root = scratch_dir(spark, "catalog")
    ensure_namespaces(spark, ["silver", "gold"], root)
    m = _m(spark, sf)
    materialize(teams(m), "silver.teams", as_="view")
    models = gold_models(m, only=("team_form", "match_results"))
    for name in ("team_form", "match_results"):
        materialize(models[name], f"gold.{name}", as_="table", path=f"{root}/gold/{name}")
    return list_tables(spark, ["silver", "gold"])


def _lake(spark, sf):
    ensure_utc(spark)
    root = scratch_dir(spark, "lake")
    write_raw(fx.raw_matches(spark, sf, with_date=True), f"{root}/bronze/kind=matches")
    write_raw(fx.standings_docs(spark, sf, with_date=True), f"{root}/bronze/kind=standings")
    return full_run(spark, LakeConfig(root), committed_at=datetime(2024, 1, 15, 12, 0, 0))


def q_run_full(spark, sf):
    """The checks of the backfill chain."""
    return _lake(spark, sf).checks


def q_run_full_history(spark, sf):
    """The history that closes the backfill chain."""
    return _lake(spark, sf).history.select("table_name", "operation", "added_records", "total_records", "rows_at_snapshot")


def q_quarantine(spark, sf):
    """All versions of all matches split into good and bad rows, as stored."""
    rows, path = _unified(spark, sf), scratch_dir(spark, "quarantine")
    write_quarantine(rows, path, match_rules())
    good = read_quarantine(spark, path, rows.schema, "good").withColumn("reasons", F.array().cast("array<string>"))
    bad = read_quarantine(spark, path, rows.schema, "bad")
    return good.withColumn("verdict", F.lit("good")).unionByName(bad.withColumn("verdict", F.lit("bad"))).select(
        "match_id", "source", "ingested_at", "verdict", F.array_join("reasons", ",").alias("reasons"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
