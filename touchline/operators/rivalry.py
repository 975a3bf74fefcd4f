"""Head-to-head tables and pair filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import canonical_pair_columns, escape_like


def head_to_head(results: DataFrame) -> DataFrame:
    """Per unordered pair (string id order): matches, wins each side, draws and
    average total goals rounded to 2 (HALF_UP)."""
    pairs = results.select(*canonical_pair_columns(), "home_score", "away_score")
    w = F.col("winner_id")
    return (pairs.groupBy("team_a_id", "team_a_name", "team_b_id", "team_b_name").agg(
        F.count(F.lit(1)).alias("total_matches"),
        F.sum(F.when(w == F.col("team_a_id"), 1).otherwise(0)).alias("team_a_wins"),
        F.sum(F.when(w == F.col("team_b_id"), 1).otherwise(0)).alias("team_b_wins"),
        F.sum(F.when(w.isNull(), 1).otherwise(0)).alias("draws"),
        F.round(F.avg(F.col("home_score") + F.col("away_score")), 2).alias("avg_total_goals")))


def name_match(col: Column, name, exact: bool) -> Column:
    """Literal case-insensitive substring match, or equality when ``exact``."""
    if isinstance(name, Column):
        if exact:
            return col == name
        pattern = F.concat(F.lit("%"), F.regexp_replace(name, r"([\\%_])", r"\\$1"), F.lit("%"))
        return F.ilike(col, pattern)
    if exact:
        return col == F.lit(name)
    return col.ilike(f"%{escape_like(name)}%")


def pair_condition(a, b, exact: bool = False, home="home_team_name", away="away_team_name") -> Column:
    """(home ~ a and away ~ b) or (home ~ b and away ~ a); ``~`` is a literal
    case-insensitive substring match, or equality when ``exact``."""
    h, w = F.col(home), F.col(away)
    return ((name_match(h, a, exact) & name_match(w, b, exact))
            | (name_match(h, b, exact) & name_match(w, a, exact)))


def pair_matches(results: DataFrame, a, b, exact: bool = False) -> DataFrame:
    """Matches between two teams, newest first (query-layer columns)."""
    return (results.filter(pair_condition(a, b, exact))
            .select("utc_date", "home_team_name", "away_team_name", "home_score", "away_score", "result")
            .orderBy(F.col("utc_date").desc_nulls_last(), "match_id"))


def pair_matches_exact(results: DataFrame, a: str, b: str) -> DataFrame:
    """Dashboard form: exact names, renamed columns."""
    return (results.filter(pair_condition(a, b, exact=True))
            .select(F.col("utc_date").alias("Date"), F.col("home_team_name").alias("Home"),
                    F.col("away_team_name").alias("Away"), F.col("home_score").alias("HG"),
                    F.col("away_score").alias("AG"), F.col("result").alias("Result"))
            .orderBy(F.col("Date").desc_nulls_last(), "match_id"))


def pair_tally(results: DataFrame, a: str, b: str) -> DataFrame:
    """Total, wins of each side and draws (= the rest) for one pair (one row)."""
    pm = results.filter(pair_condition(a, b, exact=True))
    h, w, r = F.col("home_team_name"), F.col("away_team_name"), F.col("result")

    def wins(t):
        return ((h == t) & (r == "home_win")) | ((w == t) & (r == "away_win"))

    out = pm.agg(F.count(F.lit(1)).alias("total"),
                 F.sum(F.when(wins(a), 1).otherwise(0)).alias("a_wins"),
                 F.sum(F.when(wins(b), 1).otherwise(0)).alias("b_wins"))
    return out.select(
        "total",
        F.coalesce("a_wins", F.lit(0)).cast("bigint").alias("a_wins"),
        F.coalesce("b_wins", F.lit(0)).cast("bigint").alias("b_wins"),
        (F.col("total") - F.coalesce("a_wins", F.lit(0)) - F.coalesce("b_wins", F.lit(0)))
        .cast("bigint").alias("draws"))
