"""Data-quality flag and checks.

Every check counts violating rows (0 = pass).  All checks of one table run in
one scan with one shuffle of the keys of its ``unique`` rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import all_not_null

REQUIRED_MATCH_COLUMNS = ("match_id", "home_team_id", "away_team_id", "utc_date", "status")

# Accepted vocabularies of the gold tables.
FORM_RESULTS = ("W", "D", "L")
FORM_TRENDS = ("improving", "declining")
MATCH_RESULTS = ("home_win", "draw", "away_win")
POINTS_LAST5_RANGE = (0, 15)


def add_quality_flag(df: DataFrame, required: Sequence[str] = REQUIRED_MATCH_COLUMNS) -> DataFrame:
    """``valid`` when every required column is non-null, else ``incomplete``."""
    return df.withColumn("quality_flag", F.when(all_not_null(required), F.lit("valid"))
                         .otherwise(F.lit("incomplete")))


@dataclass(frozen=True)
class Check:
    column: str
    kind: str
    violation: Column | None = None      # row-level: TRUE marks a bad row
    key: tuple[str, ...] = ()            # unique: the key columns


def not_null(col: str) -> Check:
    return Check(col, "not_null", F.col(col).isNull())


def accepted(col: str, values: Sequence) -> Check:
    """NULL is not a violation (``NOT IN`` on NULL is NULL)."""
    return Check(col, "accepted_values", ~F.col(col).isin(*values))


def between(col: str, lo, hi) -> Check:
    return Check(col, "between", (F.col(col) < lo) | (F.col(col) > hi))


def at_least(col: str, lo) -> Check:
    return Check(col, "at_least", F.col(col) < lo)


def unique(*cols: str) -> Check:
    """Number of key values (NULLs ignored) that occur more than once."""
    return Check(",".join(cols), "unique", key=tuple(cols))


def _count(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")


def run_checks(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """One row per check: ``model, column_name, check, violations, passed``.

    A row gives its key for every ``unique`` rule, and its violations of the row
    rules under no key, which a task adds up before anything moves.  Counted by
    (rule, key) once, a key that occurs more than once violates its rule."""
    row_checks = [(i, c) for i, c in enumerate(checks) if c.kind != "unique"]
    keys = [(i, c) for i, c in enumerate(checks) if c.kind == "unique"]
    bad = [F.when(c.violation, 1).otherwise(0).cast("bigint").alias(f"v{i}") for i, c in row_checks]
    if not keys:
        totals = df.agg(*[_count(c.violation).alias(f"v{i}") for i, c in row_checks])
    else:
        none = [F.lit(0).cast("bigint").alias(f"v{i}") for i, _ in row_checks]
        entries = [F.struct(F.lit(i).alias("rule"), F.when(all_not_null(c.key), F.to_json(F.struct(*c.key))).alias("key"), *none)
                   for i, c in keys]
        if row_checks:
            entries.append(F.struct(F.lit(-1).alias("rule"), F.lit("").alias("key"), *bad))
        rows = df.select(F.inline(F.array(*entries))).filter(F.col("key").isNotNull())
        sums = [F.sum(f"v{i}").alias(f"v{i}") for i, _ in row_checks]
        counted = rows.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n"), *sums)
        totals = counted.agg(*[_sum0(f"v{i}").alias(f"v{i}") for i, _ in row_checks],
                             *[_count((F.col("rule") == i) & (F.col("n") > 1)).alias(f"v{i}") for i, _ in keys])
    stacked = F.inline(F.array(*[
        F.struct(F.lit(c.column).alias("column_name"), F.lit(c.kind).alias("check"), F.col(f"v{i}").alias("violations"))
        for i, c in enumerate(checks)]))
    return totals.select(stacked).select(F.lit(model).alias("model"), "column_name", "check", "violations",
                                         (F.col("violations") == 0).alias("passed"))


def _sum0(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")


def violations(df: DataFrame, checks: Sequence[Check], columns: Sequence[str]) -> DataFrame:
    """The offending rows of row-level checks (singular tests)."""
    bad = reduce(lambda a, b: a | b, [F.coalesce(c.violation, F.lit(False)) for c in checks])
    return df.filter(bad).select(*columns)


def check_silver(df: DataFrame) -> DataFrame:
    """Rows, NULL match ids, negative scores; passes iff rows > 0 and no violation."""
    neg = (F.col("home_score") < 0) | (F.col("away_score") < 0)
    agg = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 _count(F.col("match_id").isNull()).alias("null_match_ids"),
                 _count(neg).alias("negative_scores"))
    return agg.withColumn("passed", (F.col("total_rows") > 0) & (F.col("null_match_ids") == 0)
                          & (F.col("negative_scores") == 0))


def check_gold(df: DataFrame) -> DataFrame:
    """Invalid trends (NULL is not invalid) and ``points_last5`` outside 0..15;
    an empty table does not pass."""
    lo, hi = POINTS_LAST5_RANGE
    agg = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 _count(~F.col("form_trend").isin(*FORM_TRENDS)).alias("invalid_trends"),
                 _count((F.col("points_last5") < lo) | (F.col("points_last5") > hi)).alias("invalid_points"))
    return agg.select("invalid_trends", "invalid_points",
                      ((F.col("total_rows") > 0) & (F.col("invalid_trends") == 0)
                       & (F.col("invalid_points") == 0)).alias("passed"))


# The declared tests of the four gold models.
GOLD_NOT_NULL = {
    "gold_team_form": ("team_id", "match_id", "result", "form_trend", "goals_scored",
                       "goals_conceded", "points_last5"),
    "gold_match_results": ("match_id", "result", "home_score", "away_score"),
    "gold_head_to_head": ("team_a_id", "team_b_id"),
    "gold_league_standings": ("team_id", "position"),
}
GOLD_UNIQUE = {"gold_match_results": ("match_id",), "gold_league_standings": ("team_id",)}
GOLD_ACCEPTED = {
    "gold_team_form": (("result", FORM_RESULTS), ("form_trend", FORM_TRENDS)),
    "gold_match_results": (("result", MATCH_RESULTS),),
}


def gold_ranges() -> dict[str, list[Check]]:
    """Range rules of the gold models."""
    return {"gold_team_form": [between("points_last5", 0, 15)],
            "gold_match_results": [at_least("home_score", 0), at_least("away_score", 0)]}
