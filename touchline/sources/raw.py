"""Bronze scans and ingest metadata."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.schemas import PAYLOAD_META
from touchline.session import dropping_shuffles

#: Rows of a landed file at most, about 100 MB of text.
ROWS_PER_FILE = 200_000
#: Level 3 of gzip takes a third of the time of the default level 6, for a quarter more bytes.
LANDED = {"compression": "gzip", "zlib.compress.level": "THREE"}


def read_raw(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False,
             dates: tuple[str, str] | None = None) -> DataFrame:
    """Read every raw file of one kind under ``<path>/date=YYYY-MM-DD/``.

    The schema is explicit (no inference pass, no missing-column surprises).
    Reading the folder adds the ``date`` partition column, so ``dates`` (and
    any later filter on ``date``) prunes whole folders.  ``multi_line=True``
    reads files that hold one JSON array each (every element becomes a row);
    the default reads JSON lines, also gzipped ones, as ``write_raw`` lands them.
    """
    df = (spark.read.schema(schema).option("multiLine", str(multi_line).lower())
          .option("mode", "PERMISSIVE").json(path))
    if dates is not None:
        df = df.filter(F.col("date").between(F.lit(dates[0]).cast("date"), F.lit(dates[1]).cast("date")))
    return df


def stamp_metadata(df: DataFrame, source: str, competition_id: str | Column, at: datetime | str | Column) -> DataFrame:
    """Attach ``{ingested_at, source, competition_id}`` as the payload's metadata.
    Values that differ from row to row are given as columns."""
    at = at.isoformat() if isinstance(at, datetime) else at
    def value(x):
        return (x if isinstance(x, Column) else F.lit(x)).cast("string")
    return df.withColumn(PAYLOAD_META, F.struct(value(at).alias("ingested_at"), F.lit(source).alias("source"),
                                                value(competition_id).alias("competition_id")))


def is_empty(df: DataFrame) -> bool:
    """Cheapest emptiness probe (stops at the first row)."""
    return df.isEmpty()


def write_raw(df: DataFrame, path: str, partition: str = "date") -> None:
    """Land payload rows as gzipped JSON lines under ``<path>/<partition>=.../``.

    Rows are rebalanced on the partition value first: each folder gets few
    files instead of one per input task, and AQE splits a day that holds a
    large share of the rows over several tasks instead of one.  Payloads repeat
    their field names in every row: as plain text they are most of a lake's disk.
    A compressed file is read by one task, so none has more than ROWS_PER_FILE rows.
    """
    writer = df.hint("rebalance", partition).write.mode("append").partitionBy(partition)
    with dropping_shuffles(df.sparkSession):
        writer.options(**LANDED, maxRecordsPerFile=ROWS_PER_FILE).json(path)
