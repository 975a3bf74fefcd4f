"""Composed jobs: bronze -> silver -> gold -> checks -> history.

These are ordinary Spark jobs an external scheduler calls.  The full run
recomputes all tables from all bronze; the live run reads what has landed since
the last one and gives the same silver rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.operators.dedup import keep_latest
from touchline.operators.flatten import flatten_matches, flatten_standings
from touchline.operators.form import (
    build_team_form,
    form_rows,
    ranged_form_rows,
)
from touchline.operators.quality import (
    GOLD_ACCEPTED,
    GOLD_NOT_NULL,
    GOLD_UNIQUE,
    Check,
    accepted,
    add_quality_flag,
    check_gold,
    check_silver,
    gold_ranges,
    not_null,
    run_checks,
    unique,
)
from touchline.operators.results import match_results
from touchline.operators.rivalry import head_to_head
from touchline.operators.setops import teams
from touchline.operators.snapshots import (
    commit_snapshot,
    read_at,
    read_staged,
    snapshot_report,
    snapshot_row,
    stage_snapshot,
    write_snapshot,
)
from touchline.operators.standings import league_standings
from touchline.plans.graph import Model, run_graph
from touchline.schemas import RAW_MATCH, STANDINGS_DOC
from touchline.sources.raw import is_empty
from touchline.sources.tables import path_exists
from touchline.streaming.land import land_raw, read_topics
from touchline.operators.reports import has_fresh_files


def build_silver_matches(raw: DataFrame, observation: Observation | None = None,
                         keys: Sequence[str] = ("match_id",)) -> DataFrame:
    """Flatten both shapes, flag quality, keep the newest version per ``keys``
    (``("source", "match_id")`` where the sources' ids may collide).
    ``observation`` counts the rows of unknown source."""
    unified = add_quality_flag(flatten_matches(raw, observation))
    return keep_latest(unified, list(keys), ["ingested_at"])


def build_silver_standings(docs: DataFrame) -> DataFrame:
    """TOTAL rows of every document, newest per team."""
    return keep_latest(flatten_standings(docs), ["team_id"], ["ingested_at"])


def build_match_results(matches: DataFrame, keep_unscored: bool = True) -> DataFrame:
    return match_results(matches, keep_unscored=keep_unscored)


@dataclass
class LakeConfig:
    root: str                         # shared folder: bronze/, silver/, gold/, checkpoints/
    fresh_minutes: int = 10
    buckets: int | None = None        # parts of the form windows (default: shuffle partitions)

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])


GOLD_MODEL_NAMES = ("team_form", "match_results", "silver_teams", "gold_team_form",
                    "gold_match_results", "gold_head_to_head", "gold_league_standings")


def gold_models(matches: DataFrame, buckets: int | None = None,
                only: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The gold tables of both definitions, built from silver matches.

    ``only`` names the models wanted; the others are not built (a team-form
    build samples its ranges when it is built, not when it is read).  When both
    team-form variants are built they share the ranges."""
    wanted = set(GOLD_MODEL_NAMES if only is None else only)
    ranged = None
    if {"team_form", "gold_team_form"} <= wanted:
        ranged = ranged_form_rows(matches, buckets=buckets)

    builders = {
        "team_form": lambda: build_team_form(matches, strict=False, keep_unscored=True,
                                             buckets=buckets, ranged=ranged),
        "match_results": lambda: build_match_results(matches, keep_unscored=True),
        "silver_teams": lambda: teams(matches),
        "gold_team_form": lambda: build_team_form(matches, strict=True, keep_unscored=False,
                                                  buckets=buckets, ranged=ranged),
        "gold_match_results": lambda: build_match_results(matches, keep_unscored=False),
        "gold_head_to_head": lambda: head_to_head(build_match_results(matches, keep_unscored=False)),
        "gold_league_standings": lambda: league_standings(form_rows(matches)),
    }
    return {name: build() for name, build in builders.items() if name in wanted}


def gold_checks(models: dict[str, DataFrame]) -> DataFrame:
    """The declared tests of the four gold models and their range rules as one report."""
    return reduce(DataFrame.unionByName, [run_checks(models[m], m, declared_checks(m)) for m in GOLD_NOT_NULL])


def declared_checks(model: str) -> list[Check]:
    """The declared tests and range rules of a gold model."""
    checks = [not_null(c) for c in GOLD_NOT_NULL[model]]
    checks += [accepted(c, v) for c, v in GOLD_ACCEPTED.get(model, ())]
    checks += gold_ranges().get(model, [])
    return checks + ([unique(*GOLD_UNIQUE[model])] if model in GOLD_UNIQUE else [])


#: A file may become visible so long after it was written (the longest micro-batch):
#: the next refresh reads files from this long before the last one on.
OVERLAP = timedelta(hours=1)
HIGH_WATER = "high-water"  # summary entry: when the refresh that made a snapshot began


def read_bronze(spark: SparkSession, cfg: LakeConfig, kind: str, schema: StructType,
                since: datetime | None = None) -> DataFrame | None:
    """Committed landed payloads of one kind, read through the landing's root so
    that files of unfinished batches stay hidden; None when none has landed.
    With ``since`` (UTC) only files written from then on are opened: the filter is
    on a file's own column, so older ones are left out before they are read."""
    if not path_exists(spark, cfg.path("bronze", f"kind={kind}")):
        return None
    landed = spark.read.text(cfg.path("bronze"))
    if since is not None:
        written = landed.metadataColumn("_metadata").getField("file_modification_time")
        landed = landed.filter(written >= F.lit(since.replace(tzinfo=timezone.utc)))
    rows = landed.filter(F.col("kind") == kind).select(F.from_json("value", schema).alias("row")).select("row.*")
    return None if is_empty(rows) else rows


def _snapshot_id(at: datetime) -> int:
    """Microseconds since the epoch; a time without a zone is UTC."""
    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return (at - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def refresh_silver(spark: SparkSession, cfg: LakeConfig, committed_at: datetime, only_new: bool = False) -> DataFrame | None:
    """The silver tables as one new snapshot each; a kind without payloads keeps
    its table.  Returns the newest matches, None when there are none.

    All landed payloads are read, or with ``only_new`` those of the files written
    since the last refresh (its high-water mark, kept in the ledger), which are
    merged with the stored rows by keep-latest.  keep-latest has a total order, so
    both give the same rows, also when a file is read twice.  (The fallback for
    payloads that all have an unknown source is decided for the files read.)"""
    sid, began, newest = _snapshot_id(committed_at), _now(), None
    for kind, schema, build, keys in (("standings", STANDINGS_DOC, build_silver_standings, ["team_id"]),
                                      ("matches", RAW_MATCH, build_silver_matches, ["match_id"])):
        path = cfg.path("silver", kind)
        last = snapshot_row(spark, path) if only_new else None
        since = datetime.fromisoformat(last["summary"][HIGH_WATER]) - OVERLAP if last else None
        raw = read_bronze(spark, cfg, kind, schema, since)
        if raw is not None:
            rows = build(raw)
            if last:
                stored = read_at(spark, path, last["snapshot_id"])
                rows = keep_latest(stored.unionByName(rows), keys, ["ingested_at"])
            write_snapshot(rows, path, f"silver.{kind}", sid, committed_at, notes={HIGH_WATER: began.isoformat()})
        if kind == "matches" and snapshot_row(spark, path) is not None:
            newest = read_at(spark, path, snapshot_row(spark, path)["snapshot_id"])
    return newest


def _summary(checked: DataFrame, model: str, check: str, violations: Column) -> DataFrame:
    return checked.select(F.lit(model).alias("model"), F.lit("*").alias("column_name"), F.lit(check).alias("check"),
                          violations.alias("violations"), "passed")


def _silver_report(silver: DataFrame) -> DataFrame:
    violations = F.col("null_match_ids") + F.col("negative_scores")
    return _summary(check_silver(silver), "silver_matches", "validate_silver", violations)


def _gold_report(form: DataFrame) -> DataFrame:
    violations = F.col("invalid_trends") + F.col("invalid_points")
    return _summary(check_gold(form), "team_form", "validate_gold", violations)


def model_graph(buckets: int | None = None) -> list[Model]:
    """The gold tables of both definitions with their inputs and declared checks."""
    def declared(name: str) -> Callable[[DataFrame], DataFrame]:
        return lambda rows: run_checks(rows, name, declared_checks(name))

    return [
        Model("team_form", ("silver.matches",), lambda m: build_team_form(m, keep_unscored=True, buckets=buckets), _gold_report),
        Model("match_results", ("silver.matches",), lambda m: build_match_results(m, keep_unscored=True)),
        Model("silver_teams", ("silver.matches",), teams),
        Model("gold_team_form", ("silver.matches",), lambda m: build_team_form(m, strict=True, buckets=buckets), declared("gold_team_form")),
        Model("gold_match_results", ("silver.matches",), lambda m: build_match_results(m, keep_unscored=False), declared("gold_match_results")),
        Model("gold_head_to_head", ("gold_match_results",), head_to_head, declared("gold_head_to_head")),
        Model("gold_league_standings", ("gold_team_form",), league_standings, declared("gold_league_standings")),
    ]


class SnapshotStore:
    """Models as snapshots: staged data is the table's only once its ledger row is written."""

    def __init__(self, spark: SparkSession, cfg: LakeConfig, committed_at: datetime):
        self.spark, self.cfg, self.at, self.sid = spark, cfg, committed_at, _snapshot_id(committed_at)
        self.staged: dict[str, tuple[int, StructType]] = {}

    def stage(self, name: str, rows: DataFrame) -> DataFrame:
        path = self.cfg.path("gold", name)
        if snapshot_row(self.spark, path, self.sid) is None:  # a rerun finds its table there
            self.staged[name] = (stage_snapshot(rows, path, self.sid), rows.schema)
        return read_staged(self.spark, path, self.sid, rows.schema)

    def publish(self, name: str) -> None:
        if name in self.staged:
            n, schema = self.staged[name]
            commit_snapshot(self.spark, self.cfg.path("gold", name), f"gold.{name}", self.sid, self.at, n, schema)


NO_CHECKS = "model string, column_name string, check string, violations bigint, passed boolean"
#: Tables whose history closes a full run.
HISTORY_TABLES = ("silver.matches", "silver.standings", "gold.team_form", "gold.match_results")


@dataclass
class FullRun:
    """What a full run reports: check rows, snapshot history of the main tables, state of each model."""

    checks: DataFrame
    history: DataFrame | None
    states: dict[str, str]


def full_run(spark: SparkSession, cfg: LakeConfig, committed_at: datetime, enforce: bool = False) -> FullRun:
    """Backfill chain over all that the landing wrote: silver -> models in the
    order of their inputs, each written once and checked from storage -> history.
    A rerun with the same time changes nothing.  With ``enforce`` a model whose
    checks fail keeps its old table and all models below it are skipped; without
    (as the reference does) checks are reported.  When no match has landed all
    tables stay as they are."""
    silver = refresh_silver(spark, cfg, committed_at)
    if silver is None:
        return FullRun(spark.createDataFrame([], NO_CHECKS), None, {})
    run = run_graph(model_graph(cfg.buckets), {"silver.matches": silver}, SnapshotStore(spark, cfg, committed_at), enforce)
    checks = reduce(DataFrame.unionByName, [_silver_report(silver), *run.reports])
    tables = [(t, cfg.path(*t.split("."))) for t in HISTORY_TABLES]
    history = snapshot_report(spark, [(t, p) for t, p in tables if snapshot_row(spark, p) is not None])
    return FullRun(checks, history, run.states)


def run_full(spark: SparkSession, cfg: LakeConfig, committed_at: datetime) -> DataFrame:
    """The check report of ``full_run``."""
    return full_run(spark, cfg, committed_at).checks


def run_live(spark: SparkSession, cfg: LakeConfig, messages_path: str, since: datetime) -> DataFrame:
    """Live chain: land new messages -> fresh? -> silver (matches and standings)
    from the files landed since the last refresh -> silver check."""
    nothing = spark.createDataFrame([], "total_rows bigint, null_match_ids bigint, negative_scores bigint, passed boolean")
    q = land_raw(read_topics(spark, messages_path), cfg.path("bronze"),
                 cfg.path("checkpoints", "land"))
    q.awaitTermination()
    if not has_fresh_files(spark, cfg.path("bronze"), since - timedelta(minutes=cfg.fresh_minutes)):
        return nothing
    silver = refresh_silver(spark, cfg, _now(), only_new=True)
    return nothing if silver is None else check_silver(silver)


__all__ = ["build_silver_matches", "build_silver_standings", "build_match_results", "gold_models", "gold_checks",
           "model_graph", "read_bronze", "refresh_silver", "full_run", "run_full", "run_live", "FullRun", "LakeConfig"]
