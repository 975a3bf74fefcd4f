"""Packing counts the pieces once."""

from touchline.llm.packing import pack
from touchline.llm.tokenizer_files import vocabulary


def test_pieces_are_read_for_their_rows_only(spark):
    docs = spark.createDataFrame([(i, "some words of a text " * (i * 37 % 900)) for i in range(60)], "doc_id long, text string")
    packed = pack(docs, vocabulary("word_bpe_49k.json"))
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    read = [line for line in plan.splitlines() if "Relation [" in line]
    assert sum("powers" in line for line in read) == 1  # the full sequences; the rest is in a table of its own
    assert packed.agg({"length": "sum"}).first()[0] == docs.join(packed.groupBy("doc_id").agg({"doc_tokens": "max"}), "doc_id").agg({"max(doc_tokens)": "sum"}).first()[0]
