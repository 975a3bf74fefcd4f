"""Match results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import match_result
from touchline.operators.form import finished, valid_rows

RESULT_COLUMNS = ("match_id", "competition_id", "utc_date", "matchday",
                  "home_team_id", "home_team_name", "away_team_id", "away_team_name",
                  "home_score", "away_score", "result")


def match_results(matches: DataFrame, keep_unscored: bool = True, valid_only: bool = False) -> DataFrame:
    """Finished matches with ``home_win``/``away_win``/``draw``.

    ``keep_unscored=True`` is the DataFrame builder (NULL score -> draw, 12
    columns with ``source``); ``False`` is the SQL model (both scores required,
    11 columns).
    """
    f = finished(valid_rows(matches, valid_only))
    if keep_unscored:
        return f.select(*RESULT_COLUMNS[:-1],
                        match_result("home_score", "away_score").alias("result"), "source")
    f = f.filter(F.col("home_score").isNotNull() & F.col("away_score").isNotNull())
    return f.select(*RESULT_COLUMNS[:-1],
                    match_result("home_score", "away_score", strict=True).alias("result"))
