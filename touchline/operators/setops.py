"""Distinct sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def teams(matches: DataFrame) -> DataFrame:
    """Team dimension: distinct (team_id, team_name, competition_id) over home and
    away sides, ids non-null.  One scan (``inline`` of both sides) and one
    distinct (partial aggregation before the shuffle)."""
    sides = F.array(
        F.struct(F.col("home_team_id").alias("team_id"), F.col("home_team_name").alias("team_name"),
                 F.col("competition_id").alias("competition_id")),
        F.struct(F.col("away_team_id").alias("team_id"), F.col("away_team_name").alias("team_name"),
                 F.col("competition_id").alias("competition_id")),
    )
    return (matches.select(F.inline(sides)).filter(F.col("team_id").isNotNull()).distinct())


def team_names(form: DataFrame) -> DataFrame:
    """Ordered distinct team names (pick list)."""
    return form.select("team_name").distinct().orderBy(F.col("team_name").asc_nulls_last())
