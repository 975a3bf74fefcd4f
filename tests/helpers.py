from datetime import datetime

from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampNTZType

MATCH_SCHEMA = StructType([
    StructField("match_id", StringType()), StructField("competition_id", StringType()),
    StructField("utc_date", TimestampNTZType()), StructField("status", StringType()),
    StructField("matchday", IntegerType()), StructField("home_team_id", StringType()),
    StructField("home_team_name", StringType()), StructField("away_team_id", StringType()),
    StructField("away_team_name", StringType()), StructField("home_score", IntegerType()),
    StructField("away_score", IntegerType()), StructField("source", StringType()),
])


def match(mid, day, h, a, hs, as_, status="finished", hn=None, an=None):
    return (str(mid), "C0", datetime(2024, 1, day), status, 1, h, hn or f"Team {h}", a,
            an or f"Team {a}", hs, as_, "src")


def matches_df(spark, rows):
    return spark.createDataFrame(rows, MATCH_SCHEMA)
