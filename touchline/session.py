"""Session helpers: the library never builds its own session inside operators.

``local_session`` is for tests, the bench and scripts only.  ``scratch_dir``
hands out fresh folders under the shared checkpoint directory the cluster
names in ``spark.checkpoint.dir``; only when that is unset (local runs) does
it pick one of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "touchline") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TOUCHLINE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Timestamps without an offset are read as UTC wall-clock time."""
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "GMT", "Z"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query run inside are deleted when it ends.  Otherwise
    they stay until the driver happens to collect its garbage, and those of
    several finished writes fill the executors' disks at once.  For queries that
    are run once, such as writes."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # Spark 4.1 on; unknown to older ones
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables."""
    root = None
    try:
        root = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf not visible in some modes
        root = None
    if not root:
        try:
            root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        except Exception:  # pragma: no cover
            root = None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        # Unset (tests, laptops): pick our own, once per session.
        root = tempfile.mkdtemp(prefix="touchline-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    else:
        try:
            if spark.sparkContext.getCheckpointDir() is None:
                spark.sparkContext.setCheckpointDir(root)
        except Exception:  # pragma: no cover - no SparkContext (Spark Connect)
            pass
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/touchline/{name}-{uuid.uuid4().hex[:12]}"


def write_scratch(df, name: str):
    """Cut lineage: write ``df`` once as a Parquet table in a fresh folder under
    the shared checkpoint root and return a read of it.  For large
    intermediates: compressed and columnar, where a reliable ``checkpoint()``
    stores uncompressed rows (cheaper only for small ones).  The result
    survives executor loss like any table."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # known schema: no footer-reading job
