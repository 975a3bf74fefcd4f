"""Explicit schemas for every raw input (never inferred) and the silver/gold outputs."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# The two raw match sources and their source labels.
SOURCE_NESTED = "football-data.org"
SOURCE_FLAT = "thesportsdb.com"
DEFAULT_COMPETITION = "PL"
DEFAULT_STAGE = "REGULAR_SEASON"

# Payload field that carries ingest metadata; renamed on read because the name
# clashes with Spark's hidden file-metadata column.
PAYLOAD_META = "_metadata"
META = "ingest_meta"


def _s(*fields):
    return StructType(list(fields))


def _f(name, dtype, nullable=True):
    return StructField(name, dtype, nullable)


INGEST_META = _s(
    _f("ingested_at", StringType()),
    _f("source", StringType()),
    _f("competition_id", StringType()),
)

TEAM_REF = _s(_f("id", StringType()), _f("name", StringType()))

# 1.1 nested match source
NESTED_MATCH = _s(
    _f("id", StringType()),
    _f("utcDate", StringType()),
    _f("status", StringType()),
    _f("matchday", IntegerType()),
    _f("stage", StringType()),
    _f("competition", _s(_f("code", StringType()))),
    _f("homeTeam", TEAM_REF),
    _f("awayTeam", TEAM_REF),
    _f("score", _s(_f("fullTime", _s(_f("home", IntegerType()), _f("away", IntegerType()))))),
    _f(PAYLOAD_META, INGEST_META),
)

# 1.2 flat match source: numbers arrive as text
FLAT_FIELDS = (
    "idEvent", "dateEvent", "strTime", "strStatus", "intRound",
    "idHomeTeam", "strHomeTeam", "idAwayTeam", "strAwayTeam",
    "intHomeScore", "intAwayScore",
)
FLAT_MATCH = _s(*[_f(n, StringType()) for n in FLAT_FIELDS], _f(PAYLOAD_META, INGEST_META))

# Both shapes land in the same folder: one superset schema reads either.
RAW_MATCH = _s(*[f for f in NESTED_MATCH.fields if f.name != PAYLOAD_META],
               *[f for f in FLAT_MATCH.fields])

# 1.3 standings document
STANDING_ROW = _s(
    _f("position", IntegerType()),
    _f("team", TEAM_REF),
    _f("playedGames", IntegerType()),
    _f("won", IntegerType()),
    _f("draw", IntegerType()),
    _f("lost", IntegerType()),
    _f("points", IntegerType()),
    _f("goalsFor", IntegerType()),
    _f("goalsAgainst", IntegerType()),
    _f("goalDifference", IntegerType()),
)
STANDINGS_DOC = _s(
    _f("standings", ArrayType(_s(_f("type", StringType()), _f("table", ArrayType(STANDING_ROW))))),
    _f(PAYLOAD_META, INGEST_META),
)

# 1.4 message on a topic (file-source stand-in for a broker record)
MESSAGE = _s(
    _f("topic", StringType()),
    _f("key", StringType()),
    _f("value", StringType()),
    _f("timestamp", TimestampNTZType()),
)



def as_sent(schema: StructType) -> StructType:
    """The schema of a nested payload as its publisher sends it: ids are numbers.
    Readers take them as text, so that ids of both sources are alike."""
    def sent(name, dtype):
        if isinstance(dtype, StructType):
            return as_sent(dtype)
        if isinstance(dtype, ArrayType):
            return ArrayType(sent("", dtype.elementType), dtype.containsNull)
        return LongType() if name == "id" else dtype
    return StructType([StructField(f.name, sent(f.name, f.dataType), f.nullable) for f in schema.fields])


# 2. silver / gold
SILVER_MATCH = _s(
    *[_f(n, StringType()) for n in ("match_id", "competition_id")],
    _f("utc_date", TimestampNTZType()),
    _f("status", StringType()),
    _f("matchday", IntegerType()),
    *[_f(n, StringType()) for n in ("stage", "home_team_id", "home_team_name",
                                    "away_team_id", "away_team_name")],
    _f("home_score", IntegerType()),
    _f("away_score", IntegerType()),
    _f("ingested_at", TimestampNTZType()),
    _f("source", StringType()),
)
SILVER_STANDING = _s(
    *[_f(n, StringType()) for n in ("team_id", "team_name")],
    *[_f(n, IntegerType()) for n in ("position", "played_games", "won", "draw", "lost", "points",
                                     "goals_for", "goals_against", "goal_difference")],
    _f("ingested_at", TimestampNTZType()),
)

# The field of each source that fills a silver column.
NESTED_FIELDS = {
    "match_id": "id",
    "competition_id": "competition.code",
    "utc_date": "utcDate",
    "status": "status",
    "matchday": "matchday",
    "stage": "stage",
    "home_team_id": "homeTeam.id",
    "home_team_name": "homeTeam.name",
    "away_team_id": "awayTeam.id",
    "away_team_name": "awayTeam.name",
    "home_score": "score.fullTime.home",
    "away_score": "score.fullTime.away",
}
FLAT_FIELD_OF = {
    "match_id": "idEvent",
    "status": "strStatus",
    "matchday": "intRound",
    "home_team_id": "idHomeTeam",
    "home_team_name": "strHomeTeam",
    "away_team_id": "idAwayTeam",
    "away_team_name": "strAwayTeam",
    "home_score": "intHomeScore",
    "away_score": "intAwayScore",
}
STANDING_FIELDS = {
    "team_id": "team.id",
    "team_name": "team.name",
    "position": "position",
    "played_games": "playedGames",
    "won": "won",
    "draw": "draw",
    "lost": "lost",
    "points": "points",
    "goals_for": "goalsFor",
    "goals_against": "goalsAgainst",
    "goal_difference": "goalDifference",
}

SNAPSHOT_LEDGER = _s(
    _f("table_name", StringType(), False),
    _f("snapshot_id", LongType(), False),
    _f("committed_at", TimestampNTZType(), False),
    _f("operation", StringType(), False),
    _f("summary", MapType(StringType(), StringType())),
)
