"""Tables, namespaces and model materialisation (session catalog)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

TABLE_LIST = StructType([
    StructField("namespace", StringType()),
    StructField("table_name", StringType()),
    StructField("table_type", StringType()),
    StructField("is_temporary", BooleanType()),
])


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or a Parquet folder by path."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, asked of the Hadoop file system (no
    failing read, so no failed query reaches the session's listeners).  A path
    that cannot be read for another reason is an error, not a missing one."""
    if hasattr(spark, "_jsparkSession"):
        fs, p = _file_system(spark, path)
        return bool(fs.exists(p))
    try:  # pragma: no cover - Spark Connect: no JVM here
        spark.read.format("binaryFile").load(path).limit(0).collect()
        return True
    except AnalysisException as error:  # pragma: no cover
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, sorted; none when it does not exist."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of a table that newer files of the same table replace."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def ensure_namespaces(spark: SparkSession, names: Sequence[str], location_root: str | None = None) -> None:
    for ns in names:
        loc = f" LOCATION '{location_root.rstrip('/')}/{ns}.db'" if location_root else ""
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS `{ns}`{loc}")


def materialize(df: DataFrame, name: str, as_: str = "view", path: str | None = None) -> DataFrame:
    """Silver models become temp views, gold models tables (external when ``path``)."""
    spark = df.sparkSession
    if as_ == "view":
        df.createOrReplaceTempView(name.replace(".", "_"))
        return spark.table(name.replace(".", "_"))
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def list_tables(spark: SparkSession, namespaces: Sequence[str]) -> DataFrame:
    """Tables of the given namespaces (catalog metadata, a handful of rows)."""
    rows = []
    for ns in namespaces:
        for t in spark.catalog.listTables(ns):
            rows.append((ns, t.name, t.tableType, bool(t.isTemporary)))
    return spark.createDataFrame(rows, TABLE_LIST)
