"""What a full run holds on disk: compressed landings, and no shuffle files of finished writes."""

import glob
import os
import time

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from touchline import fixtures as fx
from touchline.operators.snapshots import read_staged, stage_snapshot
from touchline.schemas import RAW_MATCH, STANDINGS_DOC
from touchline.session import scratch_dir
from touchline.sources import raw


def _bytes(folder):
    return sum(os.path.getsize(f) for f in glob.glob(f"{folder}/**/*.json*", recursive=True))


def _same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_landed_payloads_are_compressed_and_whole(spark, monkeypatch):
    monkeypatch.setattr(raw, "ROWS_PER_FILE", 300, raising=False)
    for schema, rows in ((RAW_MATCH, fx.raw_matches(spark, SF_SMALL, with_date=True)),
                         (STANDINGS_DOC, fx.standings_docs(spark, SF_SMALL, with_date=True))):
        root = scratch_dir(spark, "t-landed")
        raw.write_raw(rows, f"{root}/landed")
        rows.write.partitionBy("date").json(f"{root}/text")
        assert 5 * _bytes(f"{root}/landed") < _bytes(f"{root}/text")
        landed = raw.read_raw(spark, f"{root}/landed", schema)
        _same(landed, raw.read_raw(spark, f"{root}/text", schema))
        # one task reads a compressed file: none may hold a whole day
        per_file = landed.groupBy(F.input_file_name()).count().agg(F.max("count"), F.count(F.lit(1))).first()
        assert per_file[0] <= 300 and per_file[1] >= landed.count() / 300


def _shuffles(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for b in blocks.mkString(" ").split() if b.startswith("shuffle_")}


def test_finished_writes_leave_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    root, earlier, setting = scratch_dir(spark, "t-shuffles"), _shuffles(spark), spark.conf.get(key)
    rows = spark.range(5000).withColumn("date", F.col("id") % 3)
    counts = rows.groupBy("date").count()
    assert stage_snapshot(counts, f"{root}/table", 1) == 3
    raw.write_raw(rows, f"{root}/landed")
    for _ in range(100):  # files are deleted in the background
        left = _shuffles(spark) - earlier
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(key) == setting
    _same(read_staged(spark, f"{root}/table", 1, counts.schema), counts)
