"""Team form stored by ranges of (team, time): few files for a report, part of them for a refresh.

    rows/bucket=<b>/    the form rows of one key range, sorted by (team, time, match)
    bounds/             the lowest key of every range but the first
    teams/              rows of each (team name, team id) in each range
    layout/             one row: which variant of the form this is

Ranges are those of ``range_rows``, so a team that holds a third of all rows
lies in many of them and a small one in one.  A report looks its teams up in
``teams`` (as many rows as teams and ranges together) and opens only the
ranges that hold their newest rows; within a file, statistics and a Bloom
filter on the name skip row groups.

``refresh_form`` takes the match rows that are gone and those that are new
(late, corrected, deleted matches).  A change reaches the rows of its two teams
from its own place to nine rows beyond (four for the rolling frame, five for
the trend).  The ranges of those places are found by comparing keys with the
bounds; they are recomputed from the stored rows, the change and the nine rows
before them, and put in place of the old ones.  No other range is read or
written, nor is silver.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from touchline.operators.form import build_team_form, form_rows, ranged_form_rows
from touchline.operators.rivalry import name_match
from touchline.operators.windows import BUCKET, RangedRows, range_rows
from touchline.session import write_scratch
from touchline.sources.tables import remove_folder

RANGE = "bucket"
KEYS = ("team_id", "utc_date", "match_id")
#: Rows beyond a change that it can reach, and rows before a range that its windows need.
REACH = 9


def store_form(matches: DataFrame, path: str, strict: bool = False, keep_unscored: bool = True,
               buckets: int | None = None) -> None:
    """Build the team form of ``matches`` and write it by ranges."""
    ranged = ranged_form_rows(matches, buckets=buckets)
    form = build_team_form(matches, strict=strict, keep_unscored=keep_unscored, ranged=ranged, keep_buckets=True)
    _write_ranges(form, path)
    ranged.bounds_table().withColumnRenamed(BUCKET, RANGE).coalesce(1).write.mode("overwrite").parquet(f"{path}/bounds")
    spark = matches.sparkSession
    spark.createDataFrame([(strict, keep_unscored, form.drop(BUCKET).schema.json())],
                          "strict boolean, keep_unscored boolean, schema string").coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")
    _count_teams(read_ranges(spark, path)).write.mode("overwrite").parquet(f"{path}/teams")


def _write_ranges(form: DataFrame, path: str, into: str = "static") -> None:
    """``form`` has whole ranges in its partitions.  It replaces all stored ranges
    (``static``) or those that it has (``dynamic``)."""
    (form.withColumnRenamed(BUCKET, RANGE).sortWithinPartitions(RANGE, *KEYS)
         .write.mode("overwrite").option("partitionOverwriteMode", into)
         .option("parquet.bloom.filter.enabled#team_name", "true")
         .option("parquet.bloom.filter.adaptive.enabled", "true")  # as large as the names need, not 1 MB a file
         .partitionBy(RANGE).parquet(f"{path}/rows"))


def _count_teams(rows: DataFrame) -> DataFrame:
    return rows.groupBy("team_name", "team_id", RANGE).agg(F.count("*").alias("rows"))


def read_layout(spark: SparkSession, path: str) -> Row:
    return spark.read.schema("strict boolean, keep_unscored boolean, schema string").parquet(f"{path}/layout").first()


def read_ranges(spark: SparkSession, path: str, ranges: Iterable[int] | None = None) -> DataFrame:
    """The stored rows with their range: all, or those of some ranges (other folders are not opened)."""
    schema = StructType.fromJson(json.loads(read_layout(spark, path)["schema"]))
    rows = spark.read.schema(schema.add(RANGE, IntegerType())).parquet(f"{path}/rows")
    return rows if ranges is None else rows.filter(F.col(RANGE).isin([int(r) for r in ranges]))


def read_teams(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("team_name string, team_id string, bucket int, rows bigint").parquet(f"{path}/teams")


def read_form(spark: SparkSession, path: str, team: str | Column | None = None, exact: bool = False,
              newest: int | None = None) -> DataFrame:
    """The stored form rows of the teams whose name matches (all teams unless
    given).  With ``newest`` only the ranges that hold the newest so many rows of
    each of them are opened, which may hold more rows than asked for."""
    teams = read_teams(spark, path)
    if team is not None:
        teams = teams.filter(name_match(F.col("team_name"), team, exact))
    if newest is not None:
        later = (Window.partitionBy("team_name", "team_id").orderBy(F.col(RANGE).desc())
                 .rowsBetween(Window.unboundedPreceding, -1))
        teams = teams.withColumn("later", F.coalesce(F.sum("rows").over(later), F.lit(0))).filter(F.col("later") < newest)
    if team is None and newest is None:
        return read_ranges(spark, path).drop(RANGE)
    wanted = sorted(r[RANGE] for r in teams.select(RANGE).distinct().collect())  # at most one row per range
    return read_ranges(spark, path, wanted).drop(RANGE)


def replaced_matches(stored: DataFrame, versions: DataFrame, key: str = "match_id") -> DataFrame:
    """The stored match rows that ``versions`` replace: what ``refresh_form`` calls removed."""
    return stored.join(versions.select(key).distinct(), key, "left_semi")


def _reached(points: DataFrame, bounds: list[Row], sizes: dict[tuple, int]) -> list[int]:
    """The ranges with a change, and those that nine rows beyond one reach into.
    ``sizes`` has the stored rows of (team, range)."""
    last = {r[BUCKET]: r["last"] for r in points.groupBy(BUCKET).agg(F.max(F.struct(*KEYS)).alias("last")).collect()}
    reached = set(last)
    for at, key in last.items():
        seen = 0
        # the last team of a range goes on in the next one when that one begins with it
        while at < len(bounds) and bounds[at]["team_id"] == key["team_id"] and seen < REACH:
            at += 1
            reached.add(at)
            if at in last:
                break  # its own changes reach on from there
            seen += sizes.get((key["team_id"], at), 0)
    return sorted(reached)


def _before(reached: Iterable[int], bounds: list[Row], sizes: dict[tuple, int]) -> set[int]:
    """The ranges that hold the nine rows before the reached ones."""
    chosen, found = set(reached), set()
    for at in chosen:
        seen = 0
        while at > 0 and seen < REACH:
            team = bounds[at - 1]["team_id"]
            at -= 1
            if at not in chosen:  # a reached range may lose rows, so it is not counted on
                found.add(at)
                seen += sizes.get((team, at), 0)
            if at == 0 or bounds[at - 1]["team_id"] != team:
                break
    return found


def refresh_form(spark: SparkSession, path: str, removed: DataFrame, added: DataFrame) -> list[int]:
    """Put the change from ``removed`` to ``added`` match rows into the stored form;
    returns the ranges that were rewritten.  A corrected match is in both.  The
    new ranges are computed and written to the shared folder before they replace
    the old ones; a refresh that died is repeated with the same rows."""
    layout = read_layout(spark, path)
    held = spark.read.parquet(f"{path}/bounds").orderBy(RANGE)
    bounds = held.select(*KEYS).collect()  # one row per range
    gone, new = (range_rows(form_rows(m, keep_unscored=layout["keep_unscored"]), KEYS[:1], KEYS[1:], bounds=bounds).rows for m in (removed, added))
    new = write_scratch(new, "changed-rows")  # filters on the range stop there, outside of the search
    points = write_scratch(gone.select(BUCKET, *KEYS).unionByName(new.select(BUCKET, *KEYS)).distinct(), "changed-keys")
    touched = [r[BUCKET] for r in points.select(BUCKET).distinct().collect()]
    if not touched:
        return []
    edges = {b["team_id"] for b in bounds}  # only teams that go on from one range into the next are counted
    index = read_teams(spark, path)
    at_edges = index.filter(F.col("team_id").isin([t for t in edges if t is not None]) | F.col("team_id").isNull())
    sizes = {(r["team_id"], r[RANGE]): r["n"] for r in at_edges.groupBy("team_id", RANGE).agg(F.sum("rows").alias("n")).collect()}
    reached = _reached(points, bounds, sizes)
    involved = sorted({*reached, *_before(reached, bounds, sizes)})

    stored = read_ranges(spark, path, involved).withColumnRenamed(RANGE, BUCKET).select(*new.columns)
    # stored rows of new keys go too: a refresh that is repeated finds its own rows there
    old = points.select(*[F.col(c).alias(f"__{c}") for c in KEYS]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in KEYS]
    current = stored.join(old, same[0] & same[1] & same[2], "left_anti").unionByName(new)
    form = build_team_form(removed, strict=layout["strict"], keep_unscored=layout["keep_unscored"],
                           ranged=RangedRows(current, KEYS, bounds), keep_buckets=True)
    form = write_scratch(form.filter(F.col(BUCKET).isin(reached)), "refreshed-form")
    _write_ranges(form.repartition(F.col(BUCKET)), path, "dynamic")
    counts = write_scratch(_count_teams(form.withColumnRenamed(BUCKET, RANGE)), "refreshed-teams")
    for empty in set(reached) - {r[RANGE] for r in counts.select(RANGE).distinct().collect()}:
        remove_folder(spark, f"{path}/rows/{RANGE}={empty}")
    others = index.filter(~F.col(RANGE).isin(reached))
    write_scratch(others.unionByName(counts), "teams").write.mode("overwrite").parquet(f"{path}/teams")
    return reached
