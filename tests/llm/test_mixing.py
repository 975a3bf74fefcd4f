"""Mixing sources to target weights against SQL and a plain version."""

from collections import defaultdict

import duckdb
import pytest
from edge_rows import EDGES, SF_SMALL

from touchline.llm import mixing


def brute_targets(sizes):
    """Targets by rounds: clamp, deal the excess again by weight, until none is above its cap."""
    total, order = sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    clamped, level = set(), 0.0
    while True:
        free = [s for s in order if s not in clamped]
        if not free:
            return {s: 3.0 * sizes[s] for s in order}
        level = (total - sum(3 * sizes[s] for s in clamped)) / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not above:
            return {s: 3.0 * sizes[s] if s in clamped else level * weight[s] for s in order}
        clamped |= above


def check(rows, texts_of):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["repetitions"] * r["size"] <= r["taken"] <= (r["repetitions"] + 1) * r["size"]
    want = brute_targets(sizes)
    assert {s: pytest.approx(t) for s, t in want.items()} == target
    assert all(r["source_size"] == sizes[r["source"]] for r in rows)
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)
    assert sorted(r["size"] for r in rows) == sorted(len((t or "").encode().split()) for t in texts_of)


def test_mix_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    found = con.execute(mixing.OP12_SQL)
    names = [c[0] for c in found.description]
    rows = mixing.op12_water_filling(spark, SF_SMALL).collect()
    assert sorted(map(str, found.fetchall())) == sorted(str(tuple(r[c] for c in names)) for r in rows)
    assert rows[0].asDict().keys() >= {"doc_id", "size", "source_size", "target", "taken"}
    check(rows, [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()])


@pytest.mark.parametrize("big", [1, 40])
def test_clamped_sources(spark, big):
    """Small sources reach their caps one after the other; a third of the rows and more has one source."""
    rows = [(i, "w " * (i % 7 + 1), "hot") for i in range(200 * big)]
    rows += [(1000 + i, "w " * 3, f"s{i % 9}") for i in range(60)] + [(2000 + i, "w w", None) for i in range(2)]
    rows += [(3000, "w " * 40, "é"), (3001, "", "empty"), (3002, None, "empty"), (None, "w w w", "s1"), (None, "w w w", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    con = duckdb.connect()
    documents = docs.toPandas()
    documents["source"] = documents["source"].astype(object).where(documents["source"].notna(), None)
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    con.register("documents", documents)
    found = con.execute(mixing.OP12_SQL)
    names = [c[0] for c in found.description]
    got = mixing.mix(docs).collect()
    assert sorted(map(str, found.fetchall())) == sorted(str(tuple(r[c] for c in names)) for r in got)
    check(got, [r[1] for r in rows])
    assert any(r["target"] == 3.0 * r["source_size"] > 0 for r in got) or big == 1
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_one_hot_source_is_spread(spark):
    """Rows of one source, without ids and with one text, fill many ranges."""
    docs = spark.range(20_000).selectExpr("cast(null as long) as doc_id", "'one two' as text", "'hot' as source")
    rows = mixing.mix(docs)
    assert rows.agg({"taken": "sum"}).first()[0] == 40_000 and rows.rdd.getNumPartitions() > 0
    from pyspark.sql import functions as F

    keyed = mixing.ranged(docs.select("source", F.monotonically_increasing_id().alias("row")), [F.col("source"), F.col("row")], "test-mix")
    sizes = [r["count"] for r in keyed.groupBy("part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 2 * 20_000 / len(sizes)


def test_mix_edges(spark, edges, empty):
    rows = mixing.mix(edges).collect()
    assert len(rows) == len(EDGES)
    check(rows, [x[1] for x in EDGES])
    assert mixing.mix(empty).count() == 0
    blank = mixing.mix(edges.filter("doc_id in (2, 3, 4)")).collect()
    assert {(r["size"], r["target"], r["taken"]) for r in blank} == {(0, 0.0, 0)}
