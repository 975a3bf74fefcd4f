"""Appended versions: what a batch touches, what a read gives, what a compaction rewrites."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from touchline import fixtures as fx
from touchline.operators.dedup import keep_latest
from touchline.session import scratch_dir
from touchline.sources.tables import remove_folder
from touchline.streaming import upsert
from touchline.streaming.upsert import append_batch, compact, read_latest, read_layout

KEYS = ["l_orderkey", "l_linenumber"]
ORDER = ["l_shipdate", "l_partkey"]


def files(path):
    """Data files below a folder with their times of change."""
    path = path.removeprefix("file:")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def same(got, expect):
    assert got.count() == expect.count() and got.exceptAll(expect).isEmpty()


def newer(li, where):
    """Later versions of some rows."""
    return li.filter(where).withColumn("l_shipdate", F.lit("2030-01-01").cast(li.schema["l_shipdate"].dataType))


@pytest.fixture
def table(spark):
    """A compacted table of ``lineitem`` in eight key ranges."""
    path = scratch_dir(spark, "t-versions")
    li = fx.read_table(spark, SF_SMALL, "lineitem")
    append_batch(li, path, KEYS, ORDER, "first", n_ranges=8)
    assert compact(spark, path, ORDER) == list(range(8))
    return path, li


def test_small_batch_leaves_base_untouched(spark, table):
    path, li = table
    before = files(f"{path}/base")
    batch = newer(li, "l_linenumber = 1").orderBy("l_orderkey").limit(200)
    append_batch(batch, path, KEYS, ORDER, "second", n_ranges=16)  # the stored number of ranges holds
    assert files(f"{path}/base") == before and read_layout(spark, path)["n_ranges"] == 8
    expect = keep_latest(li.unionByName(batch), KEYS, ORDER)
    same(read_latest(spark, path, ORDER), expect)
    assert compact(spark, path, ORDER) == []  # 200 of some 6,000 rows: no range has grown
    assert files(f"{path}/base") == before
    append_batch(batch, path, KEYS, ORDER, "second", n_ranges=16)  # a replay
    append_batch(batch, path, KEYS, ORDER, "second", day=date(2020, 1, 1))  # and one on another day
    same(read_latest(spark, path, ORDER), expect)


def test_base_rows_pass_unshuffled(spark, table):
    path, li = table
    append_batch(newer(li, "l_orderkey < 20"), path, KEYS, ORDER, "second")
    plan = read_latest(spark, path, ORDER)._jdf.queryExecution().executedPlan().toString()
    body = plan[plan.index("Union"):]
    assert "BroadcastHashJoin" in body and "LeftAnti" in body and "SortMergeJoin" not in body


@pytest.mark.parametrize("bound", [0, 10**6])
def test_only_grown_ranges_are_rewritten(spark, table, bound, monkeypatch):
    """By broadcast or by shuffling the touched ranges: the read is the same."""
    monkeypatch.setattr(upsert, "BROADCAST_KEYS", bound)
    path, li = table
    before = files(f"{path}/base")
    in_two = li.withColumn("kr", upsert.range_of(KEYS, 8)).filter("kr in (1, 5)").drop("kr")
    other = li.withColumn("kr", upsert.range_of(KEYS, 8)).filter("kr = 2").drop("kr").limit(5)
    batches = [newer(in_two, "l_linenumber > 0"), newer(other, "true"), li.filter("l_orderkey % 5 = 0")]
    for i, batch in enumerate(batches[:2]):
        append_batch(batch, path, KEYS, ORDER, f"b{i}")
    expect = keep_latest(li.unionByName(batches[0]).unionByName(batches[1]), KEYS, ORDER)
    same(read_latest(spark, path, ORDER), expect)
    assert compact(spark, path, ORDER) == [1, 5]
    after = files(f"{path}/base")
    kept = {f for f in before if "/kr=1/" not in f and "/kr=5/" not in f}
    assert {f: after[f] for f in kept} == {f: before[f] for f in kept}
    assert not set(before) - kept & set(after)
    assert len(upsert._delta_folders(spark, path)) == 1  # what did not grow, folded
    same(read_latest(spark, path, ORDER), expect)
    append_batch(batches[2], path, KEYS, ORDER, "old")  # old versions change nothing
    same(read_latest(spark, path, ORDER), expect)


def test_compaction_that_died_is_repeated(spark, table, monkeypatch):
    path, li = table
    batch = newer(li, "l_orderkey % 2 = 0")
    append_batch(batch, path, KEYS, ORDER, "second")
    append_batch(newer(li, "l_orderkey < 10"), path, KEYS, ORDER, "unfinished")
    remove_folder(spark, [f for f in upsert._delta_folders(spark, path) if "unfinished" in f][0] + "/_SUCCESS")
    expect = keep_latest(li.unionByName(batch), KEYS, ORDER)
    same(read_latest(spark, path, ORDER), expect)  # a write that has not ended is not read
    monkeypatch.setattr(upsert, "remove_folder", lambda *_: None)  # dies before it removes anything
    assert compact(spark, path, ORDER, growth=0.1) == list(range(8))
    same(read_latest(spark, path, ORDER), expect)
    monkeypatch.undo()
    compact(spark, path, ORDER, growth=0.1)
    same(read_latest(spark, path, ORDER), expect)
    assert "unfinished" in str(os.listdir(f"{path}/delta/{os.listdir(f'{path}/delta')[0]}".removeprefix("file:")))


def test_null_keys_and_many_small_deltas(spark):
    path = scratch_dir(spark, "t-small")
    rows = [(1, "a"), (None, "b"), (2, "c"), (None, "d")]
    for i, row in enumerate(rows):
        append_batch(spark.createDataFrame([(*row, i)], "k int, v string, at int"), path, ["k"], ["at"], f"b{i}", n_ranges=4)
    expect = [(None, "d", 3), (1, "a", 0), (2, "c", 2)]
    def got():
        return sorted((tuple(r) for r in read_latest(spark, path, ["at"]).collect()), key=str)
    assert got() == sorted(expect, key=str)
    compact(spark, path, ["at"])
    append_batch(spark.createDataFrame([(None, "e", 9)], "k int, v string, at int"), path, ["k"], ["at"], "b9")
    compact(spark, path, ["at"], growth=100, most_deltas=0)
    assert got() == sorted([(None, "e", 9), *expect[1:]], key=str)
    with pytest.raises(ValueError):
        append_batch(spark.createDataFrame([(1, "a", 0)], "k int, v string, at int"), path, ["v"], ["at"], "x")
