"""Snapshot history and point-in-time reads over plain Parquet.

A table lives at ``<path>/data/snapshot_id=<n>/`` (one full refresh per
snapshot) with a ledger at ``<path>/ledger`` holding ``table_name,
snapshot_id, committed_at, operation, summary``.  Data is written first and
the ledger row second; readers only trust snapshots in the ledger, so a write
that died half way is invisible.  The ledger also has each snapshot's schema
and row count: a read opens the folder of its snapshot and nothing else, and
counts are not taken from the data.

With an Iceberg catalog on the classpath the same calls map to
``df.writeTo(table).createOrReplace()`` (write), ``<table>.snapshots`` (ledger)
and ``spark.read.option("snapshot-id", n).table(table)`` (read_at); none is
available here, so the Parquet layout is the one implemented and tested.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from touchline.schemas import SNAPSHOT_LEDGER
from touchline.session import dropping_shuffles
from touchline.sources.tables import path_exists

SID = "snapshot_id"
# Entries of a snapshot's summary.
ADDED, TOTAL, SCHEMA = "added-records", "total-records", "schema"


def _data(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def _ledger(path: str) -> str:
    return f"{path.rstrip('/')}/ledger"


def _folder(path: str, snapshot_id: int) -> str:
    return f"{_data(path)}/{SID}={snapshot_id}"


def write_snapshot(df: DataFrame, path: str, table_name: str, snapshot_id: int,
                   committed_at: datetime, operation: str | None = None, notes: Mapping[str, str] | None = None) -> int:
    """Full refresh as snapshot ``snapshot_id``; returns the row count (taken
    by an Observation during the write, no second job).  A snapshot that the
    ledger already holds is left as it is, so a rerun changes nothing.
    ``notes`` go into the ledger's summary."""
    done = snapshot_row(df.sparkSession, path, snapshot_id)
    if done is not None:
        return int(done["summary"][TOTAL])
    n = stage_snapshot(df, path, snapshot_id)
    commit_snapshot(df.sparkSession, path, table_name, snapshot_id, committed_at, n, df.schema, operation, notes)
    return n


def stage_snapshot(df: DataFrame, path: str, snapshot_id: int) -> int:
    """Write a snapshot's data, which no reader sees yet; returns its row count."""
    obs = Observation(f"snap_{snapshot_id}")
    with dropping_shuffles(df.sparkSession):
        df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(_folder(path, snapshot_id))
    return int(obs.get["n"])


def read_staged(spark: SparkSession, path: str, snapshot_id: int, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(_folder(path, snapshot_id))


def commit_snapshot(spark: SparkSession, path: str, table_name: str, snapshot_id: int, committed_at: datetime, n: int,
                    schema: StructType, operation: str | None = None, notes: Mapping[str, str] | None = None) -> None:
    """The ledger row that makes a staged snapshot the newest of its table."""
    first = not path_exists(spark, _ledger(path)) or read_ledger(spark, path).isEmpty()
    summary = {ADDED: str(n), TOTAL: str(n), SCHEMA: schema.json(), **(notes or {})}
    row = (table_name, int(snapshot_id), committed_at, operation or ("append" if first else "overwrite"), summary)
    spark.createDataFrame([row], SNAPSHOT_LEDGER).coalesce(1).write.mode("append").parquet(_ledger(path))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SNAPSHOT_LEDGER).parquet(_ledger(path))


def snapshot_row(spark: SparkSession, path: str, snapshot_id: int | None = None, at=None) -> Row | None:
    """The ledger row of a snapshot, of the newest one committed at or before an
    instant, or of the newest of all; None when there is none."""
    if not path_exists(spark, _ledger(path)):
        return None
    rows = read_ledger(spark, path)
    if snapshot_id is not None:
        rows = rows.filter(F.col(SID) == int(snapshot_id))
    if at is not None:
        rows = rows.filter(F.col("committed_at") <= F.lit(at).cast("timestamp_ntz"))
    return rows.orderBy(F.col("committed_at").desc(), F.col(SID).desc()).first()


def _read(spark: SparkSession, path: str, row: Row | None) -> DataFrame:
    """The data of one snapshot; without one, an empty table of the newest schema."""
    of = row or snapshot_row(spark, path)
    schema = StructType.fromJson(json.loads(of["summary"][SCHEMA]))
    return read_staged(spark, path, row[SID], schema) if row else spark.createDataFrame([], schema)


def snapshot_history(spark: SparkSession, path: str) -> DataFrame:
    """Snapshots newest first with added/total record counts."""
    return (read_ledger(spark, path)
            .select(SID, "committed_at", "operation",
                    F.col("summary")[ADDED].alias("added_records"),
                    F.col("summary")[TOTAL].alias("total_records"))
            .orderBy(F.col("committed_at").desc_nulls_last(), F.col(SID).desc()))


def read_at(spark: SparkSession, path: str, snapshot_id) -> DataFrame:
    """The table as of snapshot ``snapshot_id`` (only if the ledger has it)."""
    return _read(spark, path, snapshot_row(spark, path, snapshot_id))


def read_as_of(spark: SparkSession, path: str, ts) -> DataFrame:
    """The table as of an instant: the newest snapshot committed at or before it."""
    return _read(spark, path, snapshot_row(spark, path, at=ts))


def compare_latest(spark: SparkSession, path: str) -> DataFrame:
    """Row counts of the two newest snapshots, from the ledger, and their difference (one row)."""
    j = (read_ledger(spark, path)
         .withColumn("rk", F.row_number().over(Window.orderBy(F.col("committed_at").desc(), F.col(SID).desc())))
         .filter("rk <= 2").select(SID, "committed_at", "rk", F.col("summary")[TOTAL].cast("bigint").alias("n")))

    def pick(rk, col):
        return F.max(F.when(F.col("rk") == rk, F.col(col)))

    out = j.agg(pick(1, SID).alias("newest_snapshot_id"), pick(1, "committed_at").alias("newest_committed_at"),
                F.coalesce(pick(1, "n"), F.lit(0)).alias("newest_count"),
                pick(2, SID).alias("previous_snapshot_id"),
                pick(2, "committed_at").alias("previous_committed_at"),
                F.coalesce(pick(2, "n"), F.lit(0)).alias("previous_count"))
    return out.withColumn("row_delta", F.col("newest_count") - F.col("previous_count")) \
              .filter(F.col("previous_snapshot_id").isNotNull())


def snapshot_report(spark: SparkSession, tables: list[tuple[str, str]]) -> DataFrame:
    """History of several tables with the row count actually stored in each
    snapshot: a read of no column, which takes the counts of the files' footers."""
    parts = []
    only_ids = StructType([StructField(SID, LongType())])
    for name, path in tables:
        counts = spark.read.schema(only_ids).parquet(_data(path)).groupBy(SID).agg(F.count(F.lit(1)).alias("rows_at_snapshot"))
        h = snapshot_history(spark, path).join(counts, on=SID, how="left")
        parts.append(h.select(F.lit(name).alias("table_name"), SID, "committed_at", "operation",
                              "added_records", "total_records",
                              F.coalesce("rows_at_snapshot", F.lit(0)).alias("rows_at_snapshot")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
