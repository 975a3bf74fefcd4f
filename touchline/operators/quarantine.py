"""Good rows and quarantined rows of a table, split by its rules in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from touchline.operators.quality import REQUIRED_MATCH_COLUMNS, Check, at_least, not_null

GOOD, BAD = "good", "bad"
VERDICT, REASONS = "verdict", "reasons"


def match_rules() -> list[Check]:
    """What a silver match needs: its keys, and scores that are not negative."""
    return [*(not_null(c) for c in REQUIRED_MATCH_COLUMNS), at_least("home_score", 0), at_least("away_score", 0)]


def reasons(checks: Sequence[Check]) -> Column:
    """The row rules that a row breaks, as ``column:rule`` in the order of the rules."""
    broken = [F.when(c.violation, F.lit(f"{c.column}:{c.kind}")) for c in checks]
    return F.filter(F.array(*broken), lambda r: r.isNotNull())


def judged(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``df`` with the rules that each row breaks and its verdict."""
    return df.withColumn(REASONS, reasons(checks)).withColumn(VERDICT, F.when(F.size(REASONS) == 0, GOOD).otherwise(BAD))


def write_quarantine(df: DataFrame, path: str, checks: Sequence[Check]) -> dict[str, int]:
    """Write good and bad rows to ``<path>/verdict=good`` and ``verdict=bad`` in one
    job; returns how many of each.  To be run on the versions of a table, before
    keep-latest: rows without a key would collapse to one there."""
    seen = Observation()
    rows = judged(df, checks).observe(seen, F.count_if(F.col(VERDICT) == GOOD).alias(GOOD), F.count_if(F.col(VERDICT) == BAD).alias(BAD))
    rows.write.mode("overwrite").partitionBy(VERDICT).parquet(path)
    return dict(seen.get)


def read_quarantine(spark: SparkSession, path: str, schema: StructType, verdict: str) -> DataFrame:
    """The rows of one output, with the reasons of bad ones; the other's folder is not opened."""
    more = [StructField(REASONS, ArrayType(StringType())), StructField(VERDICT, StringType())]
    rows = spark.read.schema(StructType([*schema.fields, *more])).parquet(path).filter(F.col(VERDICT) == verdict).drop(VERDICT)
    return rows.drop(REASONS) if verdict == GOOD else rows
