"""Land keyed messages as raw JSON by kind and ingest day (Structured Streaming).

The broker source (``format("kafka")``) needs the Kafka connector jar; where
it is missing, a folder of JSON message files is the source.  Either way the
rows are ``(topic, key, value, timestamp)``.  The file sink plus checkpoint
gives exactly-once landing: a restart replays nothing that was committed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.functions.expressions import topic_kind
from touchline.schemas import MESSAGE
from touchline.sources.messages import parse_messages

# The two topics the landing job subscribes to by default.
DEFAULT_TOPICS = ("x-matches", "x-standings")


def read_topics(spark: SparkSession, path: str | None = None, topics: Sequence[str] | None = None,
                bootstrap: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of messages from the earliest offset.

    With ``bootstrap`` set, subscribes to ``topics`` on a broker; otherwise
    reads message files (JSON lines with the MESSAGE schema) under ``path``,
    optionally keeping only ``topics``.
    """
    if bootstrap:
        return (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap)
                .option("subscribe", ",".join(topics or DEFAULT_TOPICS))
                .option("startingOffsets", "earliest").load()
                .select("topic", F.col("key").cast("string").alias("key"),
                        F.col("value").cast("string").alias("value"),
                        F.col("timestamp").cast("timestamp_ntz").alias("timestamp")))
    reader = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.json(path)
    if topics:
        df = df.filter(F.col("topic").isin(*topics))
    return df


def landing_rows(stream: DataFrame, metrics_name: str | None = "landing") -> DataFrame:
    """Valid messages with their landing folder: ``kind`` by topic name and
    ``date`` = the message's (ingest) day.  Received/dropped counts are
    reported as observed metrics named ``metrics_name`` in the query progress."""
    # a valid payload has raw line breaks between its tokens only; one payload is one line
    return (parse_messages(stream, observation=metrics_name)
            .withColumn("value", F.regexp_replace("value", r"[\r\n]+", " "))
            .withColumn("kind", topic_kind("topic"))
            .withColumn("date", F.date_format("timestamp", "yyyy-MM-dd")))


def drop_repeats(stream: DataFrame, within: str) -> DataFrame:
    """Messages that did not arrive before, with the same topic, key and value,
    for at least ``within``.  The time that counts is that of arrival: no message
    is late, whatever its own timestamp, and the state holds one digest for each
    message of that span."""
    arrived = stream.withColumns({"__arrived": F.current_timestamp(), "__digest": F.sha2("value", 256)})
    return (arrived.withWatermark("__arrived", within)
            .dropDuplicatesWithinWatermark(["topic", "key", "__digest"]).drop("__arrived", "__digest"))


def land_raw(stream: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
             once_within: str | None = None) -> StreamingQuery:
    """Start the landing query: each valid payload becomes one JSON line under
    ``<path>/kind=<kind>/date=<day>/`` (readable by ``read_raw``).
    ``trigger=None`` processes what is available now and stops (scheduled
    runs); ``"30 seconds"`` keeps polling.  ``once_within`` ("1 day") lands a
    message that a broker delivers again within that time once, also across
    restarts on the same checkpoint."""
    if once_within:
        stream = drop_repeats(stream, once_within)
    writer = (landing_rows(stream).select("value", "kind", "date").writeStream.format("text")
              .option("path", path).option("checkpointLocation", checkpoint)
              .partitionBy("kind", "date").outputMode("append"))
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Committed landed payloads with their folder columns (the sink's log
    hides files of unfinished batches)."""
    return (spark.read.text(path)
            .select("kind", F.col("date").cast("date").alias("date"), "value"))
