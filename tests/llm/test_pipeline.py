"""The pipeline stage by stage: each stage's result against its operator's on the same input."""

import corpus_pipeline
from edge_rows import SF_SMALL

from touchline.llm import nearduplicates, repetition, substrings
from touchline.llm.common import write_scratch


def test_stages_keep_their_promises(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = write_scratch(stage(spark, before, SF_SMALL), "test-stage")
        ids, old = {r["doc_id"] for r in after.select("doc_id").collect()}, {r["doc_id"] for r in before.select("doc_id").collect()}
        assert ids and ids <= old
        if name == "quality_rules":
            assert ids == {r["doc_id"] for r in repetition.measure(before).filter("kept").collect()}
        if name == "near_dedup":
            assert ids == {r["class_id"] for r in nearduplicates.near_duplicate_classes(before).collect()}
        if name == "substring_dedup":
            want = {r["doc_id"]: r["text"] for r in substrings.removals(before).collect() if r["text"].split()}
            assert {r["doc_id"]: r["text"] for r in after.collect()} == want
        if name == "packing":
            assert ids == old and "sequence_id" in after.columns
        else:
            assert after.columns == names and after.count() == len(ids)
        before = after
    assert corpus_pipeline.run(spark, SF_SMALL).count() == before.count()


def test_registered_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names


def test_queries_match_sql(spark):
    import duckdb

    from touchline.llm.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    for name in ("pages", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_SMALL}/{name}.parquet')")
    for key, sql in ORACLE_SQL.items():
        got = QUERIES[key](spark, SF_SMALL)
        found = con.execute(sql)
        names = [c[0] for c in found.description]
        assert sorted(map(str, found.fetchall())) == sorted(str(tuple(r[c] for c in names)) for r in got.collect())
