"""Small Spark helpers shared by the operators of this package."""

from __future__ import annotations

import os
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import touchline
from touchline.session import write_scratch


#: Bytes of an Arrow batch between the JVM and Python, unless the session names a size of its own.
BATCH_BYTES, _BATCH = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors' Python workers, once per
    application, so that functions run there wherever the driver was started.
    Arrow batches are bounded by BATCH_BYTES where the session has Spark's default."""
    sc = spark.sparkContext
    if spark.conf.get(_BATCH, "1b") == "1b":  # not set by the session's owner
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    name = "touchline.zip"
    if name in sc._python_includes:
        return
    root = os.path.dirname(os.path.abspath(touchline.__file__))
    path = os.path.join(sc._temp_dir, name)  # the driver serves it from there; removed with the application
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


__all__ = ["ship_package", "shuffle_partitions", "table", "text_or_empty", "write_scratch"]
