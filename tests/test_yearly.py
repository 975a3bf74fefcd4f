"""Yearly snapshots compute their rows twice at most."""

from datetime import datetime

from pyspark.sql import functions as F

from touchline import fixtures as fx
from touchline.operators.snapshots import read_ledger, snapshot_report
from touchline.session import scratch_dir


def test_yearly_snapshots_compute_their_rows_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    times = [datetime(1990 + i % 3, 5, 1) if i % 10 else None for i in range(100)]
    df = spark.createDataFrame(list(enumerate(times)), "id int, at timestamp_ntz").mapInArrow(count, "id int, at timestamp_ntz")
    path = scratch_dir(spark, "t-yearly")
    fx.write_yearly_snapshots(df, path, "t", "at")
    assert seen.value <= 200
    per_year = [sum(t is not None and t.year <= y for t in times) for y in (1990, 1991, 1992)]
    got = snapshot_report(spark, [("t", path)]).orderBy("snapshot_id").collect()
    assert [(r.snapshot_id, r.committed_at, r.operation, r.total_records, r.rows_at_snapshot) for r in got] == [
        (y, datetime(y + 1, 1, 1), "append" if y == 1990 else "overwrite", str(n), n) for y, n in zip((1990, 1991, 1992), per_year)]
    assert read_ledger(spark, path).filter(F.col("summary").isNull()).isEmpty()
