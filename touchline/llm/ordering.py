"""Each document together with the next one, in descending order of ``doc_id``.

The documents are dealt into even ranges of (``doc_id``, text hash, row id),
whose bounds come from a sample of these three, so that many rows of one id
(all null ids, say) are many ranges.  The first document of each range
is sent to the range before it as well, so a task that streams its range in
order finds the successor of its last document there; the last document of all
is followed by the first.  Whole texts are shuffled once, and nothing but one
(doc_id, text hash, row id) per range reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.windows import bucket_of, sample_bounds

from .common import shuffle_partitions, text_or_empty

#: Ranges for each shuffle partition, so that hashing ranges to tasks stays even.
RANGES_PER_PARTITION = 4
LOWEST = -(1 << 63)


def with_successors(docs: DataFrame) -> DataFrame:
    """Columns ``range``, ``halo``, ``doc_id``, ``text``: partitioned by range and
    sorted by range, then own rows in descending order of ``doc_id``, then the
    halo row.  Null ids come last; rows with equal ids follow the order of their
    text hash, equal rows that of the table.  An empty table gives no row."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    key = ("k", "h", "row")
    keyed = docs.select(F.coalesce("doc_id", F.lit(LOWEST)).alias("k"), F.xxhash64("text").alias("h"),
                        F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    bounds = sample_bounds(keyed, key, RANGES_PER_PARTITION * shuffle_partitions(spark))
    keyed = keyed.withColumn("range", bucket_of(keyed, key, bounds).cast("int"))
    heads = keyed.groupBy("range").agg(F.max(F.struct(*key)).alias("head")).orderBy("range").collect()
    if not heads:
        return keyed.select("range", F.lit(False).alias("halo"), "doc_id", "text")
    # one row per range: the next range up ends with this range's first document, the lowest with the first of all
    after = [(heads[(i + 1) % len(heads)]["range"], r["head"]["k"], r["head"]["h"]) for i, r in enumerate(heads)]
    heads = spark.createDataFrame(after, "goes_to int, k long, h long")
    firsts = keyed.join(F.broadcast(heads.select("k", "h")), ["k", "h"], "left_semi").select("k", "h", "doc_id", "text").distinct()
    copies = firsts.join(F.broadcast(heads), ["k", "h"]).select(
        F.col("goes_to").alias("range"), F.lit(True).alias("halo"), "k", "h", F.lit(0).cast("long").alias("row"), "doc_id", "text")
    own = keyed.select("range", F.lit(False).alias("halo"), *key, "doc_id", "text")
    return (own.unionAll(copies).repartition("range")
            .sortWithinPartitions("range", "halo", *[F.desc(c) for c in key])
            .select("range", "halo", "doc_id", "text"))
