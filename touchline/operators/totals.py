"""Standings and head-to-head kept up to date by signed changes.

A table of totals (one row per key) is stored as additive parts:

    gen=<g>/part=<name>/

The first part holds the totals of all rows.  A change writes one more part,
named by the caller: the totals of the rows that are gone, negative, and of
the rows that are new; its size is that of the change.  A read adds the parts
up by key and leaves out keys without rows.  Writing the same part again
replaces it, so a change that is repeated counts once.  ``fold`` adds all parts
into the first part of a new generation, which holds from the moment its write
has ended; it keeps their names, so that a change repeated after it is left out.
One writer changes or folds at a time.

What is not a sum is kept as sums: a total that is NULL for a key without any
value needs the number of values, an average its sum and number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.expressions import canonical_pair_columns
from touchline.operators.form import form_rows
from touchline.operators.results import match_results
from touchline.operators.standings import rank_standings, standings_report
from touchline.sources.tables import path_exists, subfolders

#: Parts beyond which a change folds the table first.
MOST_PARTS = 64


def _n(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


@dataclass(frozen=True)
class Totals:
    """What is kept: rows of a set of matches, their key, what each adds, and which
    sum counts the rows of a key."""

    rows: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    adds: tuple[tuple[str, Column], ...]
    count: str

    def of(self, matches: DataFrame) -> DataFrame:
        rows = self.rows(matches).select(*self.keys, *[c.cast("long").alias(k) for k, c in self.adds])
        return self.sum(rows)

    def sum(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k, _ in self.adds])


def _team_adds() -> tuple[tuple[str, Column], ...]:
    result, scored, conceded = F.col("result"), F.col("goals_scored"), F.col("goals_conceded")
    return (("played", F.lit(1)), ("won", _n(result == "W")), ("drawn", _n(result == "D")), ("lost", _n(result == "L")),
            ("total_points", F.col("points")), ("goals_for", scored), ("goals_against", conceded),
            ("n_for", _n(scored.isNotNull())), ("n_against", _n(conceded.isNotNull())))


def team_totals(by: tuple[str, ...] = ("team_id", "team_name"), keep_unscored: bool = False) -> Totals:
    return Totals(lambda m: form_rows(m, keep_unscored), by, _team_adds(), "played")


def pair_totals() -> Totals:
    def rows(matches: DataFrame) -> DataFrame:
        return match_results(matches, keep_unscored=False).select(
            *canonical_pair_columns(), (F.col("home_score") + F.col("away_score")).alias("goals"))

    winner = F.col("winner_id")
    adds = (("total_matches", F.lit(1)), ("team_a_wins", _n(winner == F.col("team_a_id"))),
            ("team_b_wins", _n(winner == F.col("team_b_id"))), ("draws", _n(winner.isNull())),
            ("goals", F.col("goals")), ("n_goals", _n(F.col("goals").isNotNull())))
    return Totals(rows, ("team_a_id", "team_a_name", "team_b_id", "team_b_name"), adds, "total_matches")


def _generation(spark: SparkSession, path: str) -> int:
    """The newest generation whose first part is whole."""
    gens = sorted((int(g.split("=")[1]) for g in subfolders(spark, path)), reverse=True)
    return next(g for g in gens if path_exists(spark, f"{path}/gen={g}/part=first/_SUCCESS"))


def _parts(spark: SparkSession, path: str) -> list[str]:
    root = f"{path}/gen={_generation(spark, path)}"
    return [f"{root}/{p}" for p in subfolders(spark, root) if p.startswith("part=") and path_exists(spark, f"{root}/{p}/_SUCCESS")]


def _folded(spark: SparkSession, path: str) -> DataFrame:
    """Names of the changes that the first part holds."""
    names = f"{path}/gen={_generation(spark, path)}/names"
    return spark.read.schema("name string").parquet(names) if path_exists(spark, names) else spark.createDataFrame([], "name string")


def store_totals(matches: DataFrame, path: str, totals: Totals) -> None:
    """The totals of all ``matches``, as the first generation."""
    totals.of(matches).write.mode("overwrite").parquet(f"{path}/gen=0/part=first")


def change_totals(spark: SparkSession, path: str, totals: Totals, name: str, removed: DataFrame, added: DataFrame) -> None:
    """Add the change from ``removed`` to ``added`` match rows as the part ``name``."""
    if len(_parts(spark, path)) > MOST_PARTS:
        fold(spark, path, totals)
    if not _folded(spark, path).filter(F.col("name") == name).isEmpty():
        return
    gone = totals.of(removed).select(*totals.keys, *[(-F.col(k)).alias(k) for k, _ in totals.adds])
    change = totals.sum(gone.unionByName(totals.of(added)))
    some = F.greatest(*[F.abs(F.col(k)) for k, _ in totals.adds]) > 0  # a corrected match may change nothing
    change.filter(some).coalesce(1).write.mode("overwrite").parquet(f"{path}/gen={_generation(spark, path)}/part=change-{name}")


def read_totals(spark: SparkSession, path: str, totals: Totals) -> DataFrame:
    """One row for each key that has rows."""
    parts = spark.read.parquet(*_parts(spark, path))
    return totals.sum(parts).filter(F.col(totals.count) > 0)


def fold(spark: SparkSession, path: str, totals: Totals) -> None:
    """Add all parts into the first part of a new generation."""
    new = f"{path}/gen={_generation(spark, path) + 1}"
    names = [(p.split("/part=change-")[1],) for p in _parts(spark, path) if "/part=change-" in p]
    _folded(spark, path).unionByName(spark.createDataFrame(names, "name string")).write.mode("overwrite").parquet(f"{new}/names")
    read_totals(spark, path, totals).write.mode("overwrite").parquet(f"{new}/part=first")


def kept_standings(totals: DataFrame, by: tuple[str, ...] = ("team_id", "team_name")) -> DataFrame:
    """``league_standings`` from stored totals."""
    for goals, n in (("goals_for", "n_for"), ("goals_against", "n_against")):
        totals = totals.withColumn(goals, F.when(F.col(n) > 0, F.col(goals)))
    return rank_standings(totals.drop("n_for", "n_against"), by)


def kept_standings_by_name(totals: DataFrame) -> DataFrame:
    """``standings_by_name`` from stored totals keyed by name."""
    return standings_report(kept_standings(totals, ("team_name",)))


def kept_head_to_head(totals: DataFrame) -> DataFrame:
    """``head_to_head`` from stored totals."""
    average = F.when(F.col("n_goals") > 0, F.col("goals") / F.col("n_goals"))
    return totals.withColumn("avg_total_goals", F.round(average, 2)).drop("goals", "n_goals")
