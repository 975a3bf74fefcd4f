"""Balanced contiguous shards from global byte-size prefix sums (operator 5).

Documents are put in the order of their text's digest and ``doc_id``, so equal
texts stand together.  The global prefix sum of the sizes, from per-partition
totals, is cut at equal targets: a document belongs to the shard in which its
first byte falls, so shards differ by at most about one document.  A group of
equal texts of at most 1 / GROUP_PART of a shard goes whole with its first
document; a larger group is cut like any other rows.

Law: ``bytes``.  Native DataFrame operations only; the texts themselves are not
shuffled.  A group's first byte and size come from its partition's window; only
the groups at a partition's two ends, which may go on in the next, are added up
across partitions, so a group with a third of all rows is many tasks' work.

Edge cases: a null text counts no bytes (CRC-32 of the empty text) and groups
with empty texts; null ids sort first; repeated rows are rows of a group; with
fewer documents than shards some shards are empty; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, text_or_empty
from .prefixsums import before_parts, ranged

SHARDS, ROW_BYTES, GROUP_PART = 40, 16, 8


def shard(docs: DataFrame, shards: int = SHARDS, row_bytes: int = ROW_BYTES) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``."""
    text = text_or_empty()
    rows = docs.select(
        "doc_id", (F.octet_length(text) + row_bytes).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("group"), F.monotonically_increasing_id().alias("row_id"))
    rows = ranged(rows, [F.col("group"), F.col("doc_id"), F.col("row_id")], "sizes")
    total = rows.agg(F.sum("size").alias("total"))  # one row
    shift = before_parts(rows, {"bytes_before": F.sum("size"), "rows_before": F.count("*")})
    # one partition's rows by order: ranges are balanced by sampling, and rows equal in text and id are cut by row_id
    order = Window.partitionBy("part").orderBy("group", "doc_id", "row_id")
    within = Window.partitionBy("part", "group")
    rows = (rows.withColumn("bytes_in", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
            .withColumn("row_in", F.row_number().over(order) - 1)
            .join(F.broadcast(shift), "part")
            .select("doc_id", "size", "text_crc32", "group", "part", (F.col("bytes_before") + F.col("bytes_in")).alias("start"),
                    (F.col("rows_before") + F.col("row_in")).alias("row"))
            .withColumn("first", F.min("start").over(within)).withColumn("bytes", F.sum("size").over(within)))
    # a group that goes on in the next partition is the last or first one of each of its partitions: two rows a partition
    edge = F.struct("group", "first", "bytes")
    edges = rows.groupBy("part").agg(F.array_distinct(F.array(F.min(edge), F.max(edge))).alias("edges"))
    crossing = (edges.select(F.inline("edges")).groupBy("group")
                .agg(F.min("first").alias("all_first"), F.sum("bytes").alias("all_bytes"), F.count("*").alias("n"))
                .filter("n > 1").drop("n"))
    rows = rows.join(F.broadcast(crossing), "group", "left").join(F.broadcast(total), F.lit(True))
    rows = rows.withColumn("first", F.coalesce("all_first", "first")).withColumn("bytes", F.coalesce("all_bytes", "bytes"))
    whole = F.col("bytes") * (GROUP_PART * shards) <= F.col("total")
    rows = rows.withColumn("at", F.when(whole, F.col("first")).otherwise(F.col("start")))
    rows = rows.withColumn("shard", F.least(F.expr(f"at * {shards} div total"), F.lit(shards - 1)).cast("int"))
    firsts = rows.groupBy("shard").agg(F.min("row").alias("first_row"))  # one row per shard
    return rows.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("first_row")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op5_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
