"""Report reads over the gold tables: recent form, latest form, chained
top-team reports, chart series, date windows and freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.dedup import keep_latest
from touchline.operators.rivalry import name_match, pair_condition
from touchline.operators.standings import _rank_key

FORM_REPORT_COLUMNS = ("team_name", "utc_date", "venue", "goals_scored", "goals_conceded",
                       "result", "points", "points_last5", "avg_gf", "avg_gc", "form_trend")


def _form_report(form: DataFrame) -> DataFrame:
    return form.select("team_name", "utc_date", "venue", "goals_scored", "goals_conceded",
                       "result", "points", "points_last5",
                       F.col("goals_scored_rolling_avg_5").alias("avg_gf"),
                       F.col("goals_conceded_rolling_avg_5").alias("avg_gc"),
                       "form_trend", "match_id", "team_id")


def _newest():
    return (F.col("utc_date").desc_nulls_last(), F.col("match_id").desc_nulls_last(),
            F.col("team_id").asc_nulls_last())


def recent_form(form: DataFrame, team=None, exact: bool = False, n: int = 20) -> DataFrame:
    """Newest ``n`` form rows, optionally for one team (literal substring match,
    case-insensitive, or exact).  Plans as ``TakeOrderedAndProject``: each task
    keeps its own top ``n`` and only those move."""
    r = _form_report(form)
    if team is not None:
        r = r.filter(name_match(F.col("team_name"), team, exact))
    return r.orderBy(*_newest()).limit(n).select(*FORM_REPORT_COLUMNS)


def form_series(form: DataFrame, team: str, n: int = 20) -> DataFrame:
    """Chart series: the newest ``n`` rows of a team, oldest first."""
    r = _form_report(form).filter(F.col("team_name") == team).orderBy(*_newest()).limit(n)
    return (r.orderBy(F.col("utc_date").asc_nulls_first(), F.col("match_id").asc_nulls_first())
             .select("utc_date", "avg_gf", "avg_gc"))


def latest_form(form: DataFrame) -> DataFrame:
    """Headline metrics of every team at once: its newest form row."""
    r = _form_report(form)
    latest = keep_latest(r, ["team_name"], [F.col("utc_date").desc_nulls_last(),
                                            F.col("match_id").desc_nulls_last(),
                                            F.col("team_id").asc_nulls_last()], tiebreak=False)
    return latest.select("team_name", "utc_date", "form_trend", "points_last5", "avg_gf", "avg_gc")


def top_teams(form: DataFrame) -> DataFrame:
    """Names of the first and second team of the by-name table (one row).

    Per-team totals by partial aggregation, then a top-2 by the table order
    (``TakeOrderedAndProject``: each task keeps its own two best), pivoted
    into one row; no full ranking is needed for two names."""
    per_team = form.groupBy("team_name").agg(
        F.sum("points").alias("pts"), F.sum("goals_scored").alias("gf"),
        (F.sum("goals_scored") - F.sum("goals_conceded")).alias("gd"))
    top2 = per_team.orderBy(F.col("pts").desc_nulls_last(), F.col("gd").desc_nulls_last(),
                            F.col("gf").desc_nulls_last(), F.col("team_name").asc_nulls_last()).limit(2)
    key = _rank_key("pts", "gd", "gf", "team_name")
    first = F.min_by("team_name", key)
    second = F.when(F.count(F.lit(1)) > 1, F.max_by("team_name", key))
    return top2.agg(first.alias("first_team"), second.alias("second_team"))


def top_team_form(form: DataFrame, n: int = 20) -> DataFrame:
    """Recent form (fuzzy name match) of the current top team; the name is a
    scalar subquery, evaluated once before the filter runs."""
    top = top_teams(form).select("first_team").scalar()
    return recent_form(form, team=top, exact=False, n=n)


def top_two_history(form: DataFrame, results: DataFrame) -> DataFrame:
    """Mutual history (fuzzy names) of the top two teams, newest first.

    Both names come from one struct-valued scalar subquery (reused wherever
    it is referenced)."""
    tops = top_teams(form).select(F.struct("first_team", "second_team")).scalar()
    a, b = tops.getField("first_team"), tops.getField("second_team")
    return (results.filter(pair_condition(a, b, exact=False))
            .select("utc_date", "home_team_name", "away_team_name", "home_score",
                    "away_score", "result")
            .orderBy(F.col("utc_date").desc_nulls_last(), "match_id"))


def date_window(df: DataFrame, col: str, from_=None, to=None) -> DataFrame:
    """Rows with ``col`` between the bounds (inclusive); a missing bound means no
    filter, as outside dev mode.  The predicate reaches the Parquet scan."""
    if from_ is None or to is None:
        return df
    return df.filter(F.col(col).between(F.lit(from_).cast("timestamp_ntz"),
                                        F.lit(to).cast("timestamp_ntz")))


def fresh_rows(df: DataFrame, ts_col: str, now: str, minutes: int = 10) -> DataFrame:
    """Rows newer than ``now - minutes`` and not after ``now`` (a fixed instant)."""
    end = F.lit(now).cast("timestamp_ntz")
    start = F.timestamp_add("MINUTE", F.lit(-minutes), end)
    return df.filter((F.col(ts_col) > start) & (F.col(ts_col) <= end))


def has_fresh_files(spark: SparkSession, path: str, since, fmt: str = "text") -> bool:
    """Any file under ``path`` modified after ``since``.

    Uses the file source's hidden metadata column, reached through
    ``metadataColumn`` because landed payloads carry a ``_metadata`` field of
    their own that would shadow it.  The filter on a file-constant column
    prunes files before they are opened; the probe stops at the first row.
    """
    df = spark.read.format(fmt).load(path)
    mtime = df.metadataColumn("_metadata").getField("file_modification_time")
    return not df.select(mtime.alias("mtime")).filter(F.col("mtime") > F.lit(since)).isEmpty()
