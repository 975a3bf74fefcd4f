"""Inputs derived from the driver's test tables (never synthesised from nothing).

``orders`` is projected to a silver-like ``matches`` relation; raw payloads of
both source shapes, standings documents and a message feed are derived from it
(or from ``events``) with plain column expressions, so their size grows with
the tables.  Everything is deterministic: edge rows are chosen by modulus of the
order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.schemas import (
    FLAT_MATCH,
    NESTED_MATCH,
    PAYLOAD_META,
    RAW_MATCH,
    SNAPSHOT_LEDGER,
    SOURCE_FLAT,
    SOURCE_NESTED,
    STANDINGS_DOC,
    as_sent,
)
from touchline.sources.raw import stamp_metadata

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed parameters of the derived fixtures (the oracle SQL uses the same ones).
N_TEAMS = 20                      # teams per fixture; bench may use 1000
FIXED_NOW = "2024-01-15 12:00:00"  # stands in for now() in freshness checks
FRESH_MINUTES = 10
WINDOW_TO = "1998-08-02 00:00:00"  # date window: last 7 days before this instant
WINDOW_DAYS = 7
INGEST_BASE = "2024-01-13 00:00:00"      # first landing run of the raw versions
STANDINGS_INGEST = "2024-01-15 00:00:00"  # landing run of the standings documents


# Schemas of the (read-only) test tables, learnt on the first read.  Reading
# Parquet without a schema runs a Spark job to read a footer; with it, none.
_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    known = _SCHEMAS.get(path)
    df = (spark.read if known is None else spark.read.schema(known)).parquet(path)
    _SCHEMAS.setdefault(path, df.schema)
    return df


def _keyed_matches(spark: SparkSession, sf_dir: str, n_teams: int = N_TEAMS) -> DataFrame:
    """The matches projection plus ``k`` (the integer order key) for edge selection."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    home = F.col("o_custkey") % n_teams
    away = (F.col("o_custkey") % n_teams + 1 + k % (n_teams - 1)) % n_teams
    unscored = (F.col("o_orderstatus") == "P") | (k % 97 == 0)
    unscored = F.coalesce(unscored, F.lit(False))
    return o.select(
        k.alias("k"),
        k.cast("string").alias("match_id"),
        F.when(k % 2 == 0, F.lit("C0")).otherwise(F.lit("C1")).alias("competition_id"),
        F.col("o_orderdate").alias("utc_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit("scheduled"))
         .otherwise(F.lit("finished")).alias("status"),
        (F.lit(1) + k % 38).cast("int").alias("matchday"),
        home.cast("string").alias("home_team_id"),
        F.concat(F.lit("Team "), home.cast("string")).alias("home_team_name"),
        away.cast("string").alias("away_team_id"),
        F.concat(F.lit("Team "), away.cast("string")).alias("away_team_name"),
        F.when(unscored, F.lit(None))
         .otherwise((F.floor("o_totalprice").cast("bigint") % 5).cast("int")).alias("home_score"),
        F.when(unscored, F.lit(None))
         .otherwise((F.floor(F.col("o_totalprice") / 10).cast("bigint") % 4).cast("int"))
         .alias("away_score"),
        F.when(k % 3 == 0, F.lit(SOURCE_FLAT)).otherwise(F.lit(SOURCE_NESTED)).alias("source"),
    )


def matches(spark: SparkSession, sf_dir: str, n_teams: int = N_TEAMS) -> DataFrame:
    """Silver-like matches: 11 projected columns plus ``source``."""
    return _keyed_matches(spark, sf_dir, n_teams).drop("k")


def matches_before(spark: SparkSession, sf_dir: str, n_teams: int = N_TEAMS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """An earlier state of ``matches``, the rows of it that are gone since, and the
    rows that are new: late arrivals (k % 50 = 0), corrected scores (1), corrected
    kick-off times (2), and copies under another id that were deleted (3)."""
    m = _keyed_matches(spark, sf_dir, n_teams)
    case = F.col("k") % 50
    old = (m.withColumn("match_id", F.when(case == 3, F.concat("match_id", F.lit("x"))).otherwise(F.col("match_id")))
            .withColumn("home_score", F.when(case == 1, F.col("home_score") + 1).otherwise(F.col("home_score")).cast("int"))
            .withColumn("utc_date", F.when(case == 2, F.timestamp_add("DAY", F.lit(3), F.col("utc_date"))).otherwise(F.col("utc_date"))))
    removed = old.filter(case.isin(1, 2, 3)).drop("k")
    added = m.filter(case.isin(0, 1, 2)).drop("k")
    return m.filter(~case.isin(0, 1, 2)).drop("k").unionByName(removed), removed, added


def dirty_matches(spark: SparkSession, sf_dir: str, n_teams: int = N_TEAMS) -> DataFrame:
    """Matches with injected violations for the data-quality checks.

    NULL match id (k % 101), negative home score (k % 103) and a renamed team
    ('3' is 'Team 3 FC' at home in competition C0).
    """
    m = _keyed_matches(spark, sf_dir, n_teams)
    k = F.col("k")
    return m.select(
        F.when(k % 101 == 0, F.lit(None).cast("string")).otherwise(F.col("match_id")).alias("match_id"),
        "competition_id", "utc_date", "status", "matchday", "home_team_id",
        F.when((F.col("home_team_id") == "3") & (k % 2 == 0), F.lit("Team 3 FC"))
         .otherwise(F.col("home_team_name")).alias("home_team_name"),
        "away_team_id", "away_team_name",
        F.when((k % 103 == 0) & F.col("home_score").isNotNull(), F.lit(-1))
         .otherwise(F.col("home_score")).alias("home_score"),
        "away_score", "source",
    )


def dirty_form(form: DataFrame) -> DataFrame:
    """Team form with injected violations: bad trend (id % 53), points_last5 + 16 (id % 59)."""
    k = F.col("match_id").try_cast("bigint")
    return (form
            .withColumn("form_trend", F.when(k % 53 == 0, F.lit("flat")).otherwise(F.col("form_trend")))
            .withColumn("points_last5", F.when(k % 59 == 0, F.col("points_last5") + 16)
                        .otherwise(F.col("points_last5"))))


# ---------------------------------------------------------------- raw payloads

def _iso_z(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _iso_offset(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def match_versions(spark: SparkSession, sf_dir: str, n_teams: int = N_TEAMS) -> DataFrame:
    """Every raw version of every match, one scan of ``orders``.

    Landing runs are days 0, 1, 2 after ``INGEST_BASE``; within a run a match
    lands ``k % 86400`` seconds in.

    * primary: every match, in its own source, landed on day 1;
    * resend (k % 5): the same match from the *other* source, day 2;
    * older (k % 7): an earlier scheduled, unscored copy, day 0;
    * tie (k % 23): same source and ingest time as the primary, matchday + 1.
    """
    m = _keyed_matches(spark, sf_dir, n_teams)
    k = F.col("k")
    primary_flat = k % 3 == 0
    other = F.when(primary_flat, F.lit(SOURCE_NESTED)).otherwise(F.lit(SOURCE_FLAT))

    def version(name, applies, src, days, older, md_add):
        return F.struct(
            F.lit(name).alias("version"), applies.alias("applies"), src.alias("src"),
            F.lit(days).alias("days"), F.lit(older).alias("older"), F.lit(md_add).alias("md_add"))

    versions = F.array(
        version("primary", F.lit(True), F.col("source"), 1, False, 0),
        version("resend", k % 5 == 0, other, 2, False, 0),
        version("older", k % 7 == 0, F.col("source"), 0, True, 0),
        version("tie", k % 23 == 0, F.col("source"), 1, False, 1),
    )
    v = (m.select("*", F.inline(versions)).filter("applies").drop("applies", "source")
         .withColumnRenamed("src", "source"))
    older = F.col("older")
    return v.select(
        "k", "match_id", "competition_id", "utc_date",
        F.when(older, F.lit("scheduled")).otherwise(F.col("status")).alias("status"),
        (F.col("matchday") + F.col("md_add")).cast("int").alias("matchday"),
        F.col("matchday").alias("base_matchday"),
        "home_team_id", "home_team_name", "away_team_id", "away_team_name",
        F.when(older, F.lit(None)).otherwise(F.col("home_score")).cast("int").alias("home_score"),
        F.when(older, F.lit(None)).otherwise(F.col("away_score")).cast("int").alias("away_score"),
        "source",
        F.timestamp_add("SECOND", F.col("k") % 86400,
                        F.timestamp_add("DAY", F.col("days"), F.lit(INGEST_BASE).cast("timestamp_ntz")))
        .alias("ingested_ts"),
    )


def nested_payload(versions: DataFrame) -> DataFrame:
    """Shape 1 (nested structs) for the versions whose source is the nested API."""
    v = versions.filter(F.col("source") == SOURCE_NESTED)
    k = F.col("k")
    status = F.when((F.col("status") == "scheduled") & (k % 29 == 0), F.lit("POSTPONED")) \
        .otherwise(F.upper("status"))
    out = v.select(
        k.alias("id"),
        _iso_z(F.col("utc_date")).alias("utcDate"),
        status.alias("status"),
        F.col("matchday"),
        F.when(F.col("base_matchday") % 2 == 0, F.lit(None).cast("string"))
         .otherwise(F.lit("LEAGUE_STAGE")).alias("stage"),
        F.struct(F.when(k % 8 == 0, F.lit(None).cast("string"))
                 .otherwise(F.col("competition_id")).alias("code")).alias("competition"),
        F.struct(F.when(k % 13 == 0, F.lit(None).cast("bigint"))
                 .otherwise(F.col("home_team_id").cast("bigint")).alias("id"),
                 F.col("home_team_name").alias("name")).alias("homeTeam"),
        F.struct(F.col("away_team_id").cast("bigint").alias("id"),
                 F.col("away_team_name").alias("name")).alias("awayTeam"),
        F.struct(F.struct(F.col("home_score").alias("home"),
                          F.col("away_score").alias("away")).alias("fullTime")).alias("score"),
        *_STAMP,
    )
    return _sent(out, NESTED_MATCH, SOURCE_NESTED, _iso_z)


# What a payload's metadata is stamped with.
_STAMP = ("k", "competition_id", "ingested_ts")


def _sent(payload: DataFrame, schema: StructType, source: str, iso) -> DataFrame:
    """The payload as its publisher sends it, stamped; every fourth has no competition."""
    competition = F.when(F.col("k") % 4 != 0, F.col("competition_id"))
    stamped = stamp_metadata(payload, source, competition, iso(F.col("ingested_ts")))
    return stamped.select(*[F.col(f.name).cast(f.dataType) for f in as_sent(schema).fields])


def flat_payload(versions: DataFrame) -> DataFrame:
    """Shape 2 (flat, numbers as text) for the versions whose source is the flat API."""
    v = versions.filter(F.col("source") == SOURCE_FLAT)
    k = F.col("k")
    raw_status = (
        F.when(F.col("status") == "finished",
               F.when(k % 31 == 0, F.lit("1H")).otherwise(F.lit("Match Finished")))
         .when(F.col("status") == "scheduled",
               F.when(k % 29 == 0, F.lit("Match Postponed")).otherwise(F.lit("Not Started")))
         .otherwise(F.col("status")))
    out = v.select(
        F.col("match_id").alias("idEvent"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.date_format("utc_date", "yyyy-MM-dd")).alias("dateEvent"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
         .otherwise(F.date_format("utc_date", "HH:mm:ss")).alias("strTime"),
        raw_status.alias("strStatus"),
        F.col("matchday").cast("string").alias("intRound"),
        F.col("home_team_id").alias("idHomeTeam"),
        F.col("home_team_name").alias("strHomeTeam"),
        F.col("away_team_id").alias("idAwayTeam"),
        F.col("away_team_name").alias("strAwayTeam"),
        F.when(k % 19 == 0, F.when(F.col("home_score").isNotNull(), F.lit("x")))
         .otherwise(F.col("home_score").cast("string")).alias("intHomeScore"),
        F.col("away_score").cast("string").alias("intAwayScore"),
        *_STAMP,
    )
    return _sent(out, FLAT_MATCH, SOURCE_FLAT, _iso_offset)


def raw_matches(spark: SparkSession, sf_dir: str, n_teams: int = N_TEAMS,
                with_date: bool = False) -> DataFrame:
    """Both shapes in one superset-schema relation, as they are read from the bronze folder.

    ``with_date`` adds the ingest day used as the landing partition.
    """
    v = match_versions(spark, sf_dir, n_teams)
    nested = nested_payload(v)
    flat = flat_payload(v)
    both = nested.unionByName(flat, allowMissingColumns=True)
    cols = [F.col(f.name).cast(f.dataType) for f in RAW_MATCH.fields]
    if with_date:
        cols.append(F.to_date(F.try_to_timestamp(F.col(f"{PAYLOAD_META}.ingested_at")))
                    .alias("date"))
    return both.select(*cols)


def standings_docs(spark: SparkSession, sf_dir: str, n_teams: int = N_TEAMS,
                   with_date: bool = False, sent: bool = False) -> DataFrame:
    """One standings document per match: TOTAL (both teams), HOME and AWAY tables.

    Unscored matches carry empty tables.  Documents land in one run, ``k %
    86400`` seconds after ``STANDINGS_INGEST``.  ``sent`` gives them as they are
    published (ids are numbers) instead of as they are read.
    """
    m = _keyed_matches(spark, sf_dir, n_teams)
    hs, as_ = F.col("home_score"), F.col("away_score")
    scored = hs.isNotNull() & as_.isNotNull()

    def row(team_id, team_name, gs, gc, first):
        return F.struct(
            F.when(first, F.lit(1)).otherwise(F.lit(2)).alias("position"),
            F.struct(F.col(team_id).cast("bigint").alias("id"), F.col(team_name).alias("name")).alias("team"),
            F.col("matchday").alias("playedGames"),
            (gs > gc).cast("int").alias("won"),
            (gs == gc).cast("int").alias("draw"),
            (gs < gc).cast("int").alias("lost"),
            (F.lit(3) * (gs > gc).cast("int") + (gs == gc).cast("int")).alias("points"),
            gs.alias("goalsFor"), gc.alias("goalsAgainst"), (gs - gc).alias("goalDifference"))

    home_row = row("home_team_id", "home_team_name", hs, as_, hs >= as_)
    away_row = row("away_team_id", "away_team_name", as_, hs, as_ > hs)
    def table(*rows):
        # slice(.., 1, 0) is an empty array of the row type and stays in codegen
        return F.when(scored, F.array(*rows)).otherwise(F.slice(F.array(rows[0]), 1, 0))

    ingested = F.timestamp_add("SECOND", F.col("k") % 86400,
                               F.lit(STANDINGS_INGEST).cast("timestamp_ntz"))
    doc = m.select(
        F.array(
            F.struct(F.lit("TOTAL").alias("type"), table(home_row, away_row).alias("table")),
            F.struct(F.lit("HOME").alias("type"), table(home_row).alias("table")),
            F.struct(F.lit("AWAY").alias("type"), table(away_row).alias("table")),
        ).alias("standings"),
        F.to_date(ingested).alias("date"), "competition_id", ingested.alias("ingested_ts"),
    )
    doc = stamp_metadata(doc, SOURCE_NESTED, F.col("competition_id"), _iso_z(F.col("ingested_ts")))
    schema = as_sent(STANDINGS_DOC) if sent else STANDINGS_DOC
    cols = [F.col(f.name).cast(f.dataType) for f in schema.fields]
    if with_date:
        cols.append(F.col("date"))
    return doc.select(*cols)


# ---------------------------------------------------------------- snapshots

def write_yearly_snapshots(df: DataFrame, path: str, table_name: str, ts_col: str) -> None:
    """One cumulative snapshot per calendar year of ``ts_col`` (rows up to the
    end of that year), committed at the start of the next year.

    All snapshots are written by one job: each row is fanned out to every
    snapshot year at or after its own.  The rows of each year are counted and
    collected before (a list bounded by the calendar), so ``df`` is computed twice;
    rows with a NULL time are in no snapshot.
    """
    spark = df.sparkSession
    year = F.year(F.col(ts_col))
    counts = (df.groupBy(year.alias("y")).agg(F.count(F.lit(1)).alias("n"))
              .filter("y IS NOT NULL").orderBy("y").collect())
    years = [r["y"] for r in counts]
    fan = F.explode(F.filter(F.array(*[F.lit(y).cast("bigint") for y in years]), lambda y: y >= year))
    (df.withColumn("snapshot_id", fan)
       .write.mode("overwrite").partitionBy("snapshot_id").parquet(f"{path}/data"))
    w = Window.orderBy("y").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ledger = (spark.createDataFrame(counts, "y int, n bigint").select("y", F.sum("n").over(w).alias("total"),
                            F.row_number().over(Window.orderBy("y")).alias("seq"))
              .select(F.lit(table_name).alias("table_name"), F.col("y").cast("bigint").alias("snapshot_id"),
                      F.make_timestamp_ntz(F.col("y") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0),
                                           F.lit(0)).alias("committed_at"),
                      F.when(F.col("seq") == 1, F.lit("append")).otherwise(F.lit("overwrite"))
                      .alias("operation"),
                      F.create_map(F.lit("added-records"), F.col("total").cast("string"),
                                   F.lit("total-records"), F.col("total").cast("string"),
                                   F.lit("schema"), F.lit(df.schema.json()))
                      .alias("summary")))
    ledger.select(*[F.col(f.name).cast(f.dataType) for f in SNAPSHOT_LEDGER.fields]) \
        .write.mode("overwrite").parquet(f"{path}/ledger")


# ---------------------------------------------------------------- message feed

# Event type -> topic of the message feed.
EVENT_TOPICS = (("click", "x-matches"), ("view", "x-standings"))
OTHER_TOPIC = "x-misc"


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed messages from ``events``: every 50th value is cut (malformed), every
    50th-plus-25th is a bare JSON number (valid, not an object)."""
    e = read_table(spark, sf_dir, "events")
    topic = None
    for et, tp in EVENT_TOPICS:
        cond = F.col("event_type") == et
        topic = F.when(cond, F.lit(tp)) if topic is None else topic.when(cond, F.lit(tp))
    topic = topic.otherwise(F.lit(OTHER_TOPIC))
    eid = F.col("event_id")
    value = (F.when(eid % 50 == 0, F.expr("substring(props, 1, length(props) - 1)"))
              .when(eid % 50 == 25, (eid % 10).cast("string"))
              .otherwise(F.col("props")))
    return e.select(topic.alias("topic"), eid.cast("string").alias("key"),
                    value.alias("value"), F.col("ts").alias("timestamp"))
