"""Team form: home/away perspectives, result and points, rolling windows, trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import form_points, form_result
from touchline.operators.windows import RangedRows, bounded_window_frame, range_rows

PERSPECTIVE_COLUMNS = (
    "match_id", "competition_id", "utc_date", "team_id", "team_name",
    "opponent_id", "opponent_name", "venue", "goals_scored", "goals_conceded",
)


def finished(matches: DataFrame) -> DataFrame:
    return matches.filter(F.col("status") == "finished")


def _side(prefix: str, other: str, venue: str):
    return F.struct(
        F.col(f"{prefix}_team_id").alias("team_id"),
        F.col(f"{prefix}_team_name").alias("team_name"),
        F.col(f"{other}_team_id").alias("opponent_id"),
        F.col(f"{other}_team_name").alias("opponent_name"),
        F.lit(venue).alias("venue"),
        F.col(f"{prefix}_score").alias("goals_scored"),
        F.col(f"{other}_score").alias("goals_conceded"),
    )


def to_perspectives(matches: DataFrame, keep_unscored: bool = True) -> DataFrame:
    """One match -> two team rows (home, away) with scores swapped, in one read.

    ``keep_unscored=False`` drops a perspective whose own score is NULL (the
    SQL model's rule; a half-scored match keeps one row).
    """
    out = matches.select("match_id", "competition_id", "utc_date",
                         F.inline(F.array(_side("home", "away", "home"),
                                          _side("away", "home", "away"))))
    if not keep_unscored:
        out = out.filter(F.col("goals_scored").isNotNull())
    return out.select(*PERSPECTIVE_COLUMNS)


def add_result_points(df: DataFrame) -> DataFrame:
    return (df.withColumn("result", form_result("goals_scored", "goals_conceded"))
              .withColumn("points", form_points("goals_scored", "goals_conceded")))


def add_form_windows(ranged: RangedRows, entity: str = "team_id",
                     order: Sequence[str] = ("utc_date", "match_id"), n: int = 5,
                     strict: bool = False, extra_partition: Sequence[str] = (), keep_buckets: bool = False) -> DataFrame:
    """Rolling goals averages and points over the current and ``n-1`` previous
    rows, and the trend against the sum ``n`` rows earlier.

    Trend: no earlier sum -> improving; ``>=`` (``strict=False``) or ``>``
    (``strict=True``) -> improving; else declining.  Order ties are broken by
    ``match_id`` so results are deterministic.  All windows share one
    partitioning and one sort.  ``ranged`` comes from ``range_rows`` over the same
    partition and order, so a hot team never lands in a single task.
    """
    gs, gc = f"goals_scored_rolling_avg_{n}", f"goals_conceded_rolling_avg_{n}"
    pl = f"points_last{n}"

    def frame_fn(w_rows, w_order):
        return [
            F.round(F.avg("goals_scored").over(w_rows), 2).alias(gs),
            F.round(F.avg("goals_conceded").over(w_rows), 2).alias(gc),
            F.sum("points").over(w_rows).alias(pl),
        ]

    def trend_fn(w_rows, w_order):
        prev = F.lag(pl, n).over(w_order)
        better = (F.col(pl) > prev) if strict else (F.col(pl) >= prev)
        return [F.when(prev.isNull(), F.lit("improving"))
                 .when(better, F.lit("improving"))
                 .otherwise(F.lit("declining")).alias("form_trend")]

    return bounded_window_frame(
        ranged, partition=[entity, *extra_partition], order=list(order),
        preceding=n - 1, stages=[frame_fn, trend_fn], lookback=2 * n - 1, keep_buckets=keep_buckets)


def valid_rows(matches: DataFrame, valid_only: bool) -> DataFrame:
    """Keep only ``quality_flag = 'valid'`` rows when asked (and the flag exists)."""
    if valid_only and "quality_flag" in matches.columns:
        return matches.filter(F.col("quality_flag") == "valid")
    return matches


def form_rows(matches: DataFrame, keep_unscored: bool = False, valid_only: bool = False) -> DataFrame:
    """Finished matches -> perspectives with result and points."""
    return add_result_points(to_perspectives(finished(valid_rows(matches, valid_only)),
                                             keep_unscored=keep_unscored))


def ranged_form_rows(matches: DataFrame, keep_unscored: bool = True, valid_only: bool = False,
                     extra_partition: Sequence[str] = (), buckets: int | None = None) -> RangedRows:
    """Form rows cut into even ranges of (team, time).  With unscored matches
    kept they serve every variant of ``build_team_form``."""
    return range_rows(form_rows(matches, keep_unscored, valid_only),
                      ["team_id", *extra_partition], ["utc_date", "match_id"], buckets)


def build_team_form(matches: DataFrame, strict: bool = False, keep_unscored: bool = False,
                    n: int = 5, extra_partition: Sequence[str] = (), valid_only: bool = False,
                    buckets: int | None = None, ranged: RangedRows | None = None,
                    keep_buckets: bool = False) -> DataFrame:
    """Finished matches -> perspectives -> result/points -> windows (16 columns).

    ``strict``/``keep_unscored`` select the variant: the DataFrame builder is
    ``strict=False, keep_unscored=True``; the SQL model is ``strict=True,
    keep_unscored=False``.  ``valid_only`` skips rows flagged ``incomplete``
    (the reference computes the flag and never uses it, so it is off by
    default); ``extra_partition`` (e.g. competition) stops windows crossing it.
    ``ranged`` reuses the ranges of ``ranged_form_rows`` over the same matches and
    options; without it the keys are sampled here, for ``buckets`` parts.
    """
    if ranged is None:
        ranged = ranged_form_rows(matches, keep_unscored, valid_only, extra_partition, buckets)
    if not keep_unscored:
        ranged = ranged.where(F.col("goals_scored").isNotNull())
    return add_form_windows(ranged, n=n, strict=strict, extra_partition=extra_partition, keep_buckets=keep_buckets)
