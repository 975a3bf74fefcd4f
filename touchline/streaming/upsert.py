"""Incremental keep-latest as appended versions.

A table of the newest row per key is a folder:

    layout/                          one row: keys, number of key ranges, schema
    base/gen=<g>/kr=<r>/             one row per key, by key range
    delta/day=<day>/batch=<name>/    what one batch brought, with its key range

A batch writes one delta folder and touches no other file, so its cost is its
own size.  A read joins the two: base rows whose key no delta has pass through
unshuffled, the others meet their deltas in ``keep_latest``.  A compaction
rewrites only the key ranges whose deltas have outgrown their base, and folds
the remaining deltas into one folder.

No commit step is needed: ``keep_latest`` has a total order, so reading a
version twice changes nothing.  A batch that is replayed writes its folder
again.  A compaction writes the new files first and removes what they replace
afterwards; one that dies in between leaves versions that are read twice until
the next one.  Folders of a write that has not ended are not read.  Readers that planned before a removal may have to read again.
One writer compacts at a time; batches may be appended meanwhile.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructType

from touchline.operators.dedup import keep_latest
from touchline.sources.tables import path_exists, remove_folder, subfolders

KR, GEN, DAY, BATCH = "kr", "gen", "day", "batch"
#: A range is rewritten when its deltas hold more than this part of its base; deltas are
#: folded into one folder when there are more folders than this.
GROWTH, MOST_DELTAS = 0.5, 64
#: Changed keys that a read sends to every task; with more, it shuffles the changed ranges.
BROADCAST_KEYS = 500_000

Order = Sequence[str | Column]


def range_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")


def create_table(spark: SparkSession, table: str, schema: StructType, keys: Sequence[str], n_ranges: int) -> dict:
    """The table's layout, written on first use; a later call gets the stored one,
    so another ``n_ranges`` cannot put versions of a key into two ranges."""
    path = f"{table}/layout"
    if not path_exists(spark, path):
        row = [(json.dumps(list(keys)), n_ranges, schema.json())]
        spark.createDataFrame(row, "keys string, n_ranges int, schema string").coalesce(1).write.parquet(path)
    layout = read_layout(spark, table)
    if layout["keys"] != list(keys):
        raise ValueError(f"{table} is keyed by {layout['keys']}")
    return layout


def read_layout(spark: SparkSession, table: str) -> dict:
    row = spark.read.schema("keys string, n_ranges int, schema string").parquet(f"{table}/layout").first()
    return {"keys": json.loads(row["keys"]), "n_ranges": row["n_ranges"],
            "schema": StructType.fromJson(json.loads(row["schema"])).add(KR, IntegerType())}


def append_batch(batch: DataFrame, table: str, keys: Sequence[str], order: Order, name: str,
                 day: date | None = None, n_ranges: int = 16) -> None:
    """Write the newest rows of ``batch`` as the delta ``name`` of an ingest day
    (today unless given).  The same name on the same day replaces its own folder."""
    layout = create_table(batch.sparkSession, table, batch.schema, keys, n_ranges)
    day = day or datetime.now(timezone.utc).date()
    rows = keep_latest(batch, keys, order).withColumn(KR, range_of(keys, layout["n_ranges"]))
    (rows.select(*layout["schema"].names).sortWithinPartitions(KR)
         .write.mode("overwrite").parquet(f"{table}/delta/{DAY}={day}/{BATCH}={name}"))


def _delta_folders(spark: SparkSession, table: str) -> list[str]:
    root = f"{table}/delta"
    found = [f"{root}/{d}/{b}" for d in subfolders(spark, root) for b in subfolders(spark, f"{root}/{d}")]
    return [f for f in found if _whole(spark, f)]


def _whole(spark: SparkSession, folder: str) -> bool:
    """Whether the write of a folder has ended (its job left the success marker)."""
    return path_exists(spark, f"{folder}/_SUCCESS")


def _base_folders(spark: SparkSession, table: str) -> dict[int, list[tuple[int, str]]]:
    """Generation and folder of every stored range; at most a few per range."""
    root, found = f"{table}/base", {}
    for gen in subfolders(spark, root):
        if not _whole(spark, f"{root}/{gen}"):
            continue
        for kr in subfolders(spark, f"{root}/{gen}"):
            if kr.startswith(f"{KR}="):
                found.setdefault(int(kr.split("=")[1]), []).append((int(gen.split("=")[1]), f"{root}/{gen}/{kr}"))
    return found


def _read(spark: SparkSession, layout: dict, root: str, folders: Sequence[str]) -> DataFrame:
    names = layout["schema"].names
    if not folders:
        return spark.createDataFrame([], layout["schema"])
    return spark.read.schema(layout["schema"]).option("basePath", root).parquet(*folders).select(*names)


def _base(spark: SparkSession, table: str, layout: dict, folders: dict[int, list[tuple[int, str]]]) -> DataFrame:
    return _read(spark, layout, f"{table}/base", [max(versions)[1] for _, versions in sorted(folders.items())])


def _ranges(delta: DataFrame) -> list[int]:
    """The key ranges that the deltas touch: at most as many as the table has."""
    return [r[KR] for r in delta.select(KR).distinct().collect()]


def read_latest(spark: SparkSession, table: str, order: Order) -> DataFrame:
    """The newest row of every key."""
    layout = read_layout(spark, table)
    keys, folders = layout["keys"], _delta_folders(spark, table)
    base = _base(spark, table, layout, _base_folders(spark, table))
    if not folders:
        return base.drop(KR)
    delta = _read(spark, layout, f"{table}/delta", folders)
    touched = F.col(KR).isin(_ranges(delta))
    if delta.count() > BROADCAST_KEYS:  # the row counts of the files' footers
        newest = keep_latest(base.filter(touched).unionByName(delta), keys, order, used=[KR])
        return base.filter(~touched).unionByName(newest).drop(KR)
    changed = F.broadcast(delta.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct())
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    met = base.filter(touched).join(changed, same, "left_semi")
    newest = keep_latest(met.unionByName(delta), keys, order, used=[KR])
    return base.join(changed, same, "left_anti").unionByName(newest).drop(KR)


def compact(spark: SparkSession, table: str, order: Order, growth: float = GROWTH, most_deltas: int = MOST_DELTAS) -> list[int]:
    """Rewrite the key ranges whose deltas hold more rows than ``growth`` times
    their base; returns them.  Files of other ranges are not touched, nor are
    deltas that are appended meanwhile."""
    layout = read_layout(spark, table)
    keys, folders, stored = layout["keys"], _delta_folders(spark, table), _base_folders(spark, table)
    if not folders:
        return []
    delta, base = _read(spark, layout, f"{table}/delta", folders), _base(spark, table, layout, stored)
    sizes = base.groupBy(KR).agg(F.count("*").alias("stored"))  # a folder column: row counts of footers
    ratio = delta.groupBy(KR).agg(F.count("*").alias("new")).join(sizes, KR, "left").select(
        KR, (F.col("new") > F.coalesce("stored", F.lit(0)) * growth).alias("grown")).collect()  # one row per range
    grown = sorted(r[KR] for r in ratio if r["grown"])
    if not grown and len(folders) <= most_deltas:
        return []
    if grown:
        chosen = F.col(KR).isin(grown)
        newest = keep_latest(base.filter(chosen).unionByName(delta.filter(chosen)), keys, order, used=[KR])
        gen = 1 + max([g for versions in stored.values() for g, _ in versions], default=0)
        newest.hint("rebalance", KR).write.partitionBy(KR).mode("overwrite").parquet(f"{table}/base/{GEN}={gen}")
    if len(grown) < len(ratio):
        rest = keep_latest(delta.filter(~F.col(KR).isin(grown)), keys, order, used=[KR])
        day = datetime.now(timezone.utc).date()
        rest.sortWithinPartitions(KR).write.parquet(f"{table}/delta/{DAY}={day}/{BATCH}=folded-{uuid.uuid4().hex[:12]}")
    for old in [*folders, *(path for kr in grown for _, path in stored.get(kr, []))]:
        remove_folder(spark, old)
    return grown


def upsert_stream(stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str], order: Order,
                  n_ranges: int = 16, compact_every: int = 10, trigger: str | None = None) -> StreamingQuery:
    """Append every micro-batch of ``stream``, compacting after each
    ``compact_every`` of them.  A replayed batch has the name it had before (the
    checkpoint's and its number); on another day it is stored twice, and read once."""
    label = hashlib.sha1(checkpoint.encode()).hexdigest()[:8]

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, table, keys, order, f"{label}-{batch_id}", n_ranges=n_ranges)
        if batch_id % compact_every == compact_every - 1:
            compact(batch.sparkSession, table, order)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()
