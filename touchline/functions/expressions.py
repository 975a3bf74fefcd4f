"""Column expressions shared by the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
ANSI mode is on by default in Spark 4: every conversion of untrusted input uses
``try_*`` so bad values become NULL instead of failing the job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's): status normalisation rules, in
# order, first match wins; anything else is kept lower-cased.
STATUS_RULES = (
    ("finished", "finished"),
    ("not started", "scheduled"),
    ("postponed", "postponed"),
)

# Topic routing for landed messages, in order; else "other".
TOPIC_KINDS = ("matches", "standings")
OTHER_KIND = "other"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_status(col: str | Column) -> Column:
    """Map source-2 status text to the silver vocabulary."""
    low = F.lower(_c(col))
    expr = None
    for needle, value in STATUS_RULES:
        cond = low.contains(needle)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(low)


def topic_kind(col: str | Column) -> Column:
    """Route a topic name to a landing folder kind."""
    t = _c(col)
    expr = None
    for kind in TOPIC_KINDS:
        cond = t.contains(kind)
        expr = F.when(cond, F.lit(kind)) if expr is None else expr.when(cond, F.lit(kind))
    return expr.otherwise(F.lit(OTHER_KIND))


def parse_utc(col: str | Column) -> Column:
    """Parse ISO-8601 (``Z``/offset/micros), ``date time`` or date-only text.

    Returns a TIMESTAMP_NTZ holding UTC wall-clock time (the session time zone
    is pinned to UTC); unparsable text, and text without a date, gives NULL.
    """
    dated = _c(col).rlike(r"^\s*\d{4,6}-\d{1,2}-\d{1,2}")  # a time alone would be read as today's
    return F.when(dated, F.try_to_timestamp(_c(col))).cast("timestamp_ntz")


def epoch_ms_to_ts(col: str | Column) -> Column:
    """Milliseconds since the epoch -> UTC wall-clock TIMESTAMP_NTZ."""
    return F.timestamp_millis(_c(col)).cast("timestamp_ntz")


def all_not_null(cols) -> Column:
    return reduce(lambda a, b: a & b, [_c(c).isNotNull() for c in cols], F.lit(True))


def form_result(scored: str | Column, conceded: str | Column) -> Column:
    """W / D / L from one team's perspective; a NULL comparison falls to L."""
    s, c = _c(scored), _c(conceded)
    return F.when(s > c, F.lit("W")).when(s == c, F.lit("D")).otherwise(F.lit("L"))


def form_points(scored: str | Column, conceded: str | Column) -> Column:
    """3 / 1 / 0 points; a NULL comparison gives 0."""
    s, c = _c(scored), _c(conceded)
    return F.when(s > c, F.lit(3)).when(s == c, F.lit(1)).otherwise(F.lit(0))


def match_result(home: str | Column, away: str | Column, strict: bool = False) -> Column:
    """home_win / away_win / draw.

    ``strict=False`` (the DataFrame builder): a NULL score falls to ``draw``.
    ``strict=True`` (the SQL model): equality is tested second and the rest is
    ``away_win``; it is only applied to fully scored rows.
    """
    h, a = _c(home), _c(away)
    if strict:
        return (F.when(h > a, F.lit("home_win")).when(h == a, F.lit("draw"))
                .otherwise(F.lit("away_win")))
    return (F.when(h > a, F.lit("home_win")).when(h < a, F.lit("away_win"))
            .otherwise(F.lit("draw")))


def canonical_pair_columns(home_id="home_team_id", home_name="home_team_name",
                           away_id="away_team_id", away_name="away_team_name",
                           home_score="home_score", away_score="away_score"):
    """Unordered pair by *string* id order, names following, and the winner id.

    ``least``/``greatest`` skip NULLs; the name choice follows the ``ELSE``
    branch when an id is NULL, as the SQL model does.
    """
    hi, ai = _c(home_id), _c(away_id)
    home_first = hi < ai
    return [
        F.least(hi, ai).alias("team_a_id"),
        F.when(home_first, _c(home_name)).otherwise(_c(away_name)).alias("team_a_name"),
        F.greatest(hi, ai).alias("team_b_id"),
        F.when(home_first, _c(away_name)).otherwise(_c(home_name)).alias("team_b_name"),
        F.when(_c(home_score) > _c(away_score), hi)
         .when(_c(away_score) > _c(home_score), ai).alias("winner_id"),
    ]


def escape_like(text: str, escape: str = "\\") -> str:
    """Escape LIKE wildcards so user text is matched literally."""
    out = text.replace(escape, escape + escape)
    return out.replace("%", escape + "%").replace("_", escape + "_")
