"""Global prefix sums over a sorted table, from per-partition totals.

Native DataFrame operations only.  The rows are range-partitioned and sorted
once and written to the shared folder with their partition number; totals of
the partitions (one row each) are summed up and joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, write_scratch


def ranged(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` range-partitioned by ``order``, with the partition number as ``part``."""
    n = shuffle_partitions(rows.sparkSession)
    return write_scratch(rows.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), name)


def before_parts(parts: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """For each ``part`` what all parts before it sum up to: one row per partition."""
    totals = parts.groupBy("part").agg(*[c.alias(k) for k, c in sums.items()])
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as partitions
    return totals.select("part", *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(k) for k in sums])
