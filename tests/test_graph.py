"""Model graph, quarantine, one-scan checks and the live run."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.helpers import match, matches_df
from touchline import fixtures as fx
from touchline.operators.flatten import flatten_matches
from touchline.operators.quality import accepted, at_least, not_null, run_checks, unique
from touchline.operators.quarantine import judged, match_rules, read_quarantine, write_quarantine
from touchline.operators.snapshots import read_ledger, snapshot_row
from touchline.plans.graph import BUILT, FAILED, SKIPPED, Model, order_of, run_graph
from touchline.plans.pipelines import LakeConfig, _now, full_run, read_bronze, refresh_silver, run_live
from touchline.schemas import RAW_MATCH
from touchline.session import scratch_dir
from touchline.sources.messages import to_messages


class Memory:
    def __init__(self):
        self.staged, self.tables, self.order = {}, {}, []

    def stage(self, name, rows):
        rows.collect()
        self.order.append(name)
        self.staged[name] = rows
        return rows

    def publish(self, name):
        self.tables[name] = self.staged[name]


def passing(ok):
    return lambda rows: rows.limit(1).select(F.lit(0 if ok else 1).alias("violations"), F.lit(ok).alias("passed"))


def test_order_and_cycles():
    def model(name, *inputs):
        return Model(name, inputs, lambda *t: t[0])
    models = [model("c", "b", "src"), model("a", "src"), model("b", "a"), model("d", "c", "a")]
    assert [m.name for m in order_of(models, ["src"])] == ["a", "b", "c", "d"]
    with pytest.raises(ValueError, match="a -> b -> a|b -> a -> b"):
        order_of([model("a", "b"), model("b", "a")], [])
    with pytest.raises(ValueError, match="needs nothing"):
        order_of([model("a", "nothing")], ["src"])
    with pytest.raises(ValueError, match="twice"):
        order_of([model("a", "src"), model("a", "src")], ["src"])


def test_failed_model_stops_what_is_below(spark):
    source = spark.range(5)
    models = [Model("bad", ("src",), lambda t: t, passing(False)), Model("below", ("bad",), lambda t: t),
              Model("further", ("below", "good"), lambda a, b: a), Model("good", ("src",), lambda t: t, passing(True)),
              Model("broken", ("src",), lambda t: t.select(F.raise_error(F.lit("no")))), Model("last", ("good",), lambda t: t)]
    store = Memory()
    run = run_graph(models, {"src": source}, store, enforce=True)
    assert run.states == {"bad": FAILED, "below": SKIPPED, "good": BUILT, "further": SKIPPED, "broken": FAILED, "last": BUILT}
    assert set(store.tables) == {"good", "last"} and "no" in run.errors["broken"] and len(run.reports) == 2
    store = Memory()
    run = run_graph(models[:4], {"src": source}, store)  # reported only
    assert set(run.states.values()) == {BUILT} and store.order == ["bad", "below", "good", "further"]


def _land(spark, root, versions, day):
    rows = to_messages(fx.nested_payload(versions), "x-matches").withColumn("timestamp", F.lit(day))
    rows.write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(f"{root}/in")


def test_enforced_checks_keep_the_old_table(spark):
    root = scratch_dir(spark, "t-graph")
    cfg, v = LakeConfig(root), fx.match_versions(spark, SF_SMALL)
    _land(spark, root, v.filter("k % 13 <> 0"), datetime(2024, 1, 13))
    run_live(spark, cfg, f"{root}/in", since=datetime.now())
    first = full_run(spark, cfg, datetime(2024, 1, 15), enforce=True)
    assert set(first.states.values()) == {BUILT} and first.checks.filter("not passed").isEmpty()
    tables = {r.table_name: r.rows_at_snapshot for r in first.history.collect()}
    assert tables["gold.team_form"] == 2 * tables["gold.match_results"] > 0 and "silver.standings" not in tables
    _land(spark, root, v.filter("k % 13 = 0"), datetime(2024, 1, 14))  # payloads without a home team
    run_live(spark, cfg, f"{root}/in", since=datetime.now())
    second = full_run(spark, cfg, datetime(2024, 1, 16), enforce=True)
    assert second.states["gold_team_form"] == FAILED and second.states["gold_league_standings"] == SKIPPED
    assert second.states["gold_head_to_head"] == second.states["match_results"] == BUILT
    def snapshots(name):
        return read_ledger(spark, f"{root}/gold/{name}").count()
    assert snapshots("gold_team_form") == snapshots("gold_league_standings") == 1 and snapshots("match_results") == 2


def _files_read(df):
    """Files that the scans of an executed plan opened."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    found = [leaves.apply(i).metrics().get("numFiles") for i in range(leaves.size())]
    return sum(m.get().value() for m in found if m.isDefined())


def test_live_run_reads_new_files_only(spark, monkeypatch):
    from touchline.plans import pipelines

    monkeypatch.setattr(pipelines, "OVERLAP", timedelta(0))
    root = scratch_dir(spark, "t-live")
    cfg, v = LakeConfig(root), fx.match_versions(spark, SF_SMALL)
    for i in range(3):
        _land(spark, root, v.filter(F.col("k") % 3 == i), datetime(2024, 1, 13 + i))
        out = run_live(spark, cfg, f"{root}/in", since=datetime.now()).first()
        mark = datetime.fromisoformat(snapshot_row(spark, f"{root}/silver/matches")["summary"]["high-water"])
    assert out.total_rows == fx.nested_payload(v).select("id").distinct().count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        every, new = (_files_read(read_bronze(spark, cfg, "matches", RAW_MATCH, since)) for since in (None, mark - timedelta(seconds=1)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 0 < new < every
    assert read_bronze(spark, cfg, "matches", RAW_MATCH, _now() + timedelta(hours=1)) is None
    live = refresh_silver(spark, cfg, _now(), only_new=True)
    full = refresh_silver(spark, LakeConfig(root), _now())
    assert live.count() == full.count() and live.exceptAll(full).isEmpty()


def test_quarantine_keeps_every_row_with_reasons(spark):
    rows = flatten_matches(fx.raw_matches(spark, SF_SMALL))
    worse = rows.withColumn("home_score", F.when(F.col("match_id").cast("bigint") % 7 == 0, -1).otherwise(F.col("home_score"))).withColumn(
        "match_id", F.when(F.col("match_id").cast("bigint") % 11 == 0, None).otherwise(F.col("match_id")))
    path = scratch_dir(spark, "t-quarantine")
    counts = write_quarantine(worse, path, match_rules())
    good, bad = (read_quarantine(spark, path, worse.schema, v) for v in ("good", "bad"))
    assert counts == {"good": good.count(), "bad": bad.count()} and sum(counts.values()) == worse.count()
    assert bad.drop("reasons").unionByName(good).exceptAll(worse).isEmpty()
    both = bad.filter("match_id is null and home_score = -1").select("reasons").first()[0]
    assert both[0] == "match_id:not_null" and both[-1] == "home_score:at_least"
    assert good.filter("match_id is null or home_score < 0 or home_team_id is null").isEmpty()
    assert judged(worse.limit(0), match_rules()).isEmpty()


def test_all_checks_in_one_scan(spark):
    m = matches_df(spark, [match(1, 1, "1", "2", -1, 0), match(1, 2, "1", "2", 1, None), match(2, 2, None, "2", 0, 0), match(2, 3, None, "3", 0, 0)])
    checks = [unique("match_id"), not_null("home_team_id"), unique("home_team_id", "away_team_id"), at_least("home_score", 0), unique("utc_date"),
              accepted("status", ("finished",)), unique("home_team_id", "utc_date")]
    report = run_checks(m, "m", checks)
    got = [(r.column_name, r.check, r.violations, r.passed) for r in report.collect()]
    assert got == [("match_id", "unique", 2, False), ("home_team_id", "not_null", 2, False), ("home_team_id,away_team_id", "unique", 1, False),
                   ("home_score", "at_least", 1, False), ("utc_date", "unique", 1, False), ("status", "accepted_values", 0, True),
                   ("home_team_id,utc_date", "unique", 0, True)]
    path = scratch_dir(spark, "t-checks")
    m.write.parquet(path)
    plan = run_checks(spark.read.parquet(path), "m", checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("FileScan") == 1
    assert [r.violations for r in run_checks(m.limit(0), "m", checks).collect()] == [0] * 7
    assert [r.violations for r in run_checks(m, "m", checks[:1]).collect()] == [2]
