"""Ranked lexical search against SQL and a plain version."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from edge_rows import EDGES, SF_SMALL

from touchline.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def brute_search(docs, items, top=search.TOP):
    bags = [(d, Counter(terms_of(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        asked, scores = Counter(terms_of(text)), []
        for d, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // length
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m))
                        for t, times in asked.items() if t in b)
            if score > 0:
                scores.append((-score, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return out


def test_search_matches_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_SMALL}/{name}.parquet')")
    found = con.execute(search.OP13_SQL)
    names = [c[0] for c in found.description]
    got = [tuple(r[c] for c in names) for r in search.op13_nra_search(spark, SF_SMALL).collect()]
    assert sorted(got) == sorted(found.fetchall())
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(got) == sorted(brute_search(docs, items))


@pytest.mark.parametrize("most", [search.BLOCK_TERMS, 20])
def test_ties_nulls_and_blocks(spark, edges, empty, most, monkeypatch):
    """Large groups of equal scores, rows without ids or texts, items in one block and in many; small shards."""
    monkeypatch.setattr(search, "BLOCK_TERMS", most)
    monkeypatch.setattr(search.blocks, "__defaults__", (most,))
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(40)] + ["É", "日本", "X1"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 30)))) for i in range(150)]
    rows += [(1000 + i, "copy of one text w1 w2") for i in range(60)] + [(None, "copy of one text w1 w2")] * 3 + [(None, None), (7, ""), (8, "?! --")]
    rows += [(x[0], x[1]) for x in EDGES]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    items = [(1, "copy text"), (2, "W1 w1 w2, 日本"), (3, None), (4, "nowhere"), (None, "É x1 of"), (1, "copy text"), (5, " ".join(words))]
    asked = spark.createDataFrame([(*x, 0) for x in items], "item_id long, text string, score int")
    got = [tuple(r) for r in search.search(docs, asked).collect()]
    assert sorted(got, key=str) == sorted(brute_search(rows, items), key=str)
    assert search.search(empty, asked).count() == 0 and search.search(docs, asked.limit(0)).count() == 0


def test_intervals_end_early_and_exact():
    """Lists are read only as deep as the result asks for, and ends are exact."""
    rng = np.random.default_rng(12)
    n_docs, size = 4000, 6
    lists = [rng.choice(n_docs, 3000, replace=False) for _ in range(size - 1)] + [np.arange(30)]
    terms = np.concatenate([np.full(len(x), t) for t, x in enumerate(lists)])
    docs = np.concatenate(lists)
    counts = rng.integers(1, 50, len(docs)).astype(np.int32)
    order = np.lexsort((terms, docs))
    first = np.searchsorted(docs[order], np.arange(n_docs + 1))
    n = np.full(n_docs, 200)
    shard = search.Shard(n, first, terms[order], counts[order], size, n_docs, int(n.sum()))
    impact = (10**9 * counts.astype(np.int64)) // (1000 * counts.astype(np.int64) + 12 * 100)
    for weights in (np.array([3, 1, 2, 5, 1, 9000]), np.array([0, 0, 0, 0, 0, 7]), np.array([4, 4, 4, 4, 4, 0])):
        met, score, read = shard.best(np.arange(size), weights)
        full = np.bincount(docs, weights=weights[terms] * impact, minlength=n_docs).astype(np.int64)
        bar = np.sort(full)[-20]
        assert sorted(met.tolist()) == np.flatnonzero(full >= max(1, bar)).tolist() and (full[met] == score).all()
        assert read <= sum(len(x) for x, w in zip(lists, weights, strict=True) if w)
    assert shard.best(np.arange(5, 6), np.array([7]))[2] == 30


def test_frontiers_spare_reading():
    """One list far above the others: the rest is read to a small depth."""
    n_docs = 20_000
    terms = np.zeros(n_docs, np.int64)
    counts = np.concatenate([np.full(25, 1000), np.ones(n_docs - 25)]).astype(np.int32)
    shard = search.Shard(np.full(n_docs, 100), np.arange(n_docs + 1), terms, counts, 1, n_docs, 100 * n_docs)
    met, score, read = shard.best(np.array([0]), np.array([5]))
    assert met.tolist() == list(range(25)) and len(set(score.tolist())) == 1 and read < 100
