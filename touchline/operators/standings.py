"""League standings and headline figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.ranking import global_row_number


def _points_order(by: Sequence[str], pts="total_points", gd="goal_difference", gf="goals_for"):
    return [F.col(pts).desc_nulls_last(), F.col(gd).desc_nulls_last(), F.col(gf).desc_nulls_last(),
            *[F.col(c).asc_nulls_last() for c in by]]


def league_standings(form: DataFrame, by: Sequence[str] = ("team_id", "team_name")) -> DataFrame:
    """Played, W/D/L, points, goals and position per team (``by``).

    Partial aggregation before the shuffle; position is a distributed global
    row number by points, goal difference, goals for, then ``by`` (ties are
    broken by the team key so the order is total).  Rows come in that order.
    """
    res = F.col("result")
    agg = (form.groupBy(*by).agg(
        F.count(F.lit(1)).alias("played"),
        F.sum(F.when(res == "W", 1).otherwise(0)).alias("won"),
        F.sum(F.when(res == "D", 1).otherwise(0)).alias("drawn"),
        F.sum(F.when(res == "L", 1).otherwise(0)).alias("lost"),
        F.sum("points").alias("total_points"),
        F.sum("goals_scored").alias("goals_for"),
        F.sum("goals_conceded").alias("goals_against")))
    return rank_standings(agg, by)


def rank_standings(totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Totals of each team with goal difference and position, in order of position."""
    totals = totals.withColumn("goal_difference", F.col("goals_for") - F.col("goals_against"))
    return global_row_number(totals, _points_order(by), "position").orderBy("position")


def standings_by_name(form: DataFrame) -> DataFrame:
    """The query-layer table keyed by name: ``pts, gf, gc, gd, pos``."""
    return standings_report(league_standings(form, by=("team_name",)))


def standings_report(s: DataFrame) -> DataFrame:
    """Standings by name under the query layer's headings."""
    return s.select("team_name", "played", "won", "drawn", "lost",
                    F.col("total_points").alias("pts"), F.col("goals_for").alias("gf"),
                    F.col("goals_against").alias("gc"), F.col("goal_difference").alias("gd"),
                    F.col("position").alias("pos"))


def dashboard_standings(form: DataFrame) -> DataFrame:
    """The by-name table under the dashboard's headings, in order of position."""
    s = standings_by_name(form)
    return s.select(F.col("pos").alias("Pos"), F.col("team_name").alias("Team"), F.col("played").alias("P"),
                    F.col("won").alias("W"), F.col("drawn").alias("D"), F.col("lost").alias("L"),
                    F.col("gf").alias("GF"), F.col("gc").alias("GA"), F.col("gd").alias("GD"),
                    F.col("pts").alias("Pts"))


def _rank_key(pts, gd, gf, name):
    """Sort struct equal to ``pts DESC, gd DESC, gf DESC NULLS LAST, name``."""
    return F.struct(F.col(pts).isNull(), -F.col(pts), F.col(gd).isNull(), -F.col(gd),
                    F.col(gf).isNull(), -F.col(gf), F.col(name).isNull(), F.col(name))


def league_kpis(form: DataFrame) -> DataFrame:
    """Top team, number of teams and ``sum(played) // 2`` matches, in one pass
    over the per-name table (one row)."""
    per_team = form.groupBy("team_name").agg(
        F.count(F.lit(1)).alias("p"),
        F.sum("points").alias("pts"),
        F.sum("goals_scored").alias("gf"),
        (F.sum("goals_scored") - F.sum("goals_conceded")).alias("gd"))
    return per_team.agg(
        F.min_by("team_name", _rank_key("pts", "gd", "gf", "team_name")).alias("top_team"),
        F.count(F.lit(1)).alias("total_teams"),
        F.expr("sum(p) div 2").alias("total_matches"))
