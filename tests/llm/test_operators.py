"""Every operator against a brute-force version, and on edge cases."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge_rows import EDGES, SF_SMALL

from touchline.llm import classifier, fingerprints, nearduplicates, ordering, packing, prefixsums, repetition, sharding, substrings, tokencounts, transducer, urlfilters
from touchline.llm.textarrays import Texts
from touchline.llm.tokenizer_files import tokenizer, vocabulary


BYTE_BPE, WORD_BPE, PIECE_BPE = (vocabulary(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def words_of(text):
    return (text or "").encode().split()


# 1: fingerprints

def brute_chunks(text):
    """Chunks of a text, byte by byte."""
    data, out, start = text.encode(), [], 0
    gear = [int(g) for g in fingerprints._GEAR]
    while start < len(data):
        end = min(start + fingerprints.MAX_CHUNK, len(data))
        for cut in range(start + fingerprints.MIN_CHUNK, end + 1):
            h = 0
            for b in data[max(0, cut - 16):cut]:
                h = (2 * h + gear[b]) & 0xFFFF
            bits = fingerprints.STRICT_BITS if cut < start + fingerprints.NORMAL_CHUNK else fingerprints.LOOSE_BITS
            if h >> (16 - bits) == 0:
                end = cut
                break
        out.append(data[start:end])
        start = end
    return out


def test_chunks_follow_the_rule(real):
    texts = [x[:3000] for x in list(real[1].values())[:20]] + ["", "short"]
    ends, first = fingerprints.chunk_ends(Texts.of(texts))
    raw, bounds = Texts.of(texts).buf.tobytes(), [0, *ends]
    for i, text in enumerate(texts):
        got = [raw[bounds[k]:bounds[k + 1]] for k in range(first[i], first[i + 1])]
        assert got == brute_chunks(text)


def test_fingerprints_of_edits(spark, real):
    rows = {r["doc_id"]: r for r in fingerprints.op1_fingerprints(spark, SF_SMALL).collect()}
    order = sorted(real[1], reverse=True)
    assert sorted(rows) == sorted(order)
    for i, d in enumerate(order):
        text, after, r = real[1][d], order[(i + 1) % len(order)], rows[d]
        half = len(text) // 2
        changed = text[:len(text) - half] + real[1][after][:half]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(fingerprints.containment(r["fingerprint"], r["edited_fingerprint"]))
        assert r["near_next"] == pytest.approx(fingerprints.containment(r["fingerprint"], rows[after]["fingerprint"]))
        assert len(fingerprints.parse(r["fingerprint"])) == len(set(brute_chunks(text))) if len(text) < 2000 else True


def test_fingerprints_of_edges(edges, empty):
    rows = fingerprints.fingerprint_edits(edges).collect()
    assert len(rows) == len(EDGES) and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert all(r["fingerprint"] == "" for r in rows if r["n_chars"] == 0)
    assert fingerprints.fingerprint_edits(empty).count() == 0 and fingerprints.fingerprint(empty).count() == 0


@pytest.mark.parametrize("copies", [False, True])
def test_rows_of_one_id_are_many_ranges(spark, copies):
    """A third of all rows without an id, with different texts or all with one: ranges stay even, successors right."""
    rows = [(i, f"text {i}") for i in range(2000)] + [(None, "same" if copies else f"other {i}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sizes = {r["range"]: r["count"] for r in ordering.with_successors(docs).groupBy("range").count().collect()}
    assert len(sizes) > 20 and max(sizes.values()) < 3 * 3001 / len(sizes)
    found = fingerprints.fingerprint_edits(docs).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(d for d, _ in rows)
    following = {d: t for d, t in rows if d is not None}
    for r in found:  # the edited text shows the next document's beginning
        if r["doc_id"]:
            text, after = f"text {r['doc_id']}", following[r["doc_id"] - 1]
            assert r["edited_sha256"] == hashlib.sha256(fingerprints.edited(text, after).encode()).hexdigest()
    if copies:  # all but the last copy are followed by a copy
        one, last = (hashlib.sha256(fingerprints.edited("same", x).encode()).hexdigest() for x in ("same", "text 1999"))
        assert Counter(r["edited_sha256"] for r in found if r["doc_id"] is None) == {one: 999, last: 1}


def test_insertion_moves_few_chunks(real):
    text = max(real[1].values(), key=len)
    a, b = (fingerprints.Fingerprints(Texts.of([x])).strings()[0].as_py() for x in (text, "inserted " + text))
    assert fingerprints.containment(a, b) > 0.95


# 2: quality rules

def test_repetition_equals_brute_force(spark, real):
    for r in repetition.op2_repetition(spark, SF_SMALL).collect():
        text = real[1][r["doc_id"]]
        words, lines = words_of(text), [x for x in text.split("\n") if x.encode().split()]
        windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        twice = Counter(windows)
        inside = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(5)}
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))
        assert r["base_failed"] == (len(words) < 10 or 100 * len(inside) > 20 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_repetition_edges(edges, empty):
    rows = repetition.measure(edges).collect()
    assert len(rows) == len(EDGES) and {r["n_words"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    kept = repetition.filter_documents(edges)
    assert kept.columns == edges.columns and {r["doc_id"] for r in kept.collect()} == {1, None}
    assert repetition.measure(empty).count() == 0 and repetition.filter_documents(empty).count() == 0


# 3: transducer

def test_transducer_equals_library(spark, real, edges, empty):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    for r in transducer.op3_transducer(spark, SF_SMALL).collect():
        text = real[1][r["doc_id"]]
        assert r["ids"] == model.encode(text) and r["decoded"] == text and r["n_ids"] == len(r["ids"])
    rows = Counter((x[0], tuple(model.encode(x[1] or ""))) for x in EDGES)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in transducer.encode_documents(edges, PIECE_BPE).collect()) == rows
    assert transducer.encode_documents(empty, PIECE_BPE).count() == 0


def test_transducer_random_texts():
    import sentencepiece

    model, held = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE), transducer.Transducer.from_file(PIECE_BPE)
    rng = np.random.default_rng(5)
    parts = ["a", "th", "ing", " ", "  ", "\n", "é", "日本", "😀", "▁", "<s>", "<0x41>", "...", "x" * 9, " " * 7, "$$$", "1"]
    for _ in range(400):
        text = "".join(rng.choice(parts, rng.integers(0, 20)))
        assert held.encode(text) == model.encode(text) and held.decode(held.encode(text)) == model.decode(model.encode(text))


def test_unigram_path_is_the_cheapest():
    pieces = [("a", -1.0), ("b", -1.5), ("ab", -1.2), ("ba", -2.6), ("aba", -2.0), ("▁", -0.5)]
    held = transducer.Transducer(pieces, [True] * 6, [], transducer.UNIGRAM, dummy_space=False)

    def paths(s):
        return [[]] if not s else [[p, *rest] for p, _ in pieces if s.startswith(p) for rest in paths(s[len(p):])]

    for text in ("abab", "aab", "babaab", "ababaab"):
        cost = dict(pieces)
        best = min(-sum(cost[p] for p in path) for path in paths(text))
        assert -sum(pieces[i][1] for i in held.encode(text)) == pytest.approx(best)


# 4: substring dedup

def test_shared_passages_go_once(spark):
    rng = np.random.default_rng(1)
    passage = " ".join(f"p{x}" for x in rng.integers(0, 9999, 120))
    own = [" ".join(f"w{x}" for x in rng.integers(0, 99999, 200)) for _ in range(6)]
    texts = [f"{o[:500]} {passage} {o[500:]}" if i < 4 else o for i, o in enumerate(own)]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    rows = {r["doc_id"]: r for r in substrings.removals(docs).collect()}
    for i, t in enumerate(texts):
        spans = rows[i]["removed_spans"]
        left = "".join(t[a:b] for a, b in zip([0, *[s["end"] for s in spans]], [*[s["start"] for s in spans], len(t)], strict=True))
        assert left == rows[i]["text"] and rows[i]["removed_chars"] == len(t) - len(left)
        if 0 < i < 4:
            assert 0 in rows[i]["source_ids"] and rows[i]["removed_chars"] > 0.75 * len(passage)
            assert sum(w in rows[i]["text"].split() for w in own[i].split()) >= 195
        else:
            assert rows[i]["text"] == t
    clean = {r["doc_id"]: r for r in substrings.deduplicate(docs).collect()}
    assert all(clean[i]["text"] == rows[i]["text"] and clean[i]["n_chars"] == len(rows[i]["text"]) for i in clean) and len(clean) == 6


def test_chunk_removal_equals_brute_force(spark, real):
    """Repeated chunks by a plain dictionary over all documents in order."""
    seen, want = set(), {}
    for d in sorted(real[1]):
        chunks = substrings.Chunks(Texts.of([real[1][d]]))
        again = [k for k, x in enumerate(chunks.digest.tolist()) if x in seen or x in chunks.digest[:k].tolist()]
        seen.update(chunks.digest.tolist())
        want[d] = substrings.removed_spans(Texts.of([real[1][d]]), [again])[1][0]
    assert {r["doc_id"]: r["text"] for r in substrings.op4_chunk_dedup(spark, SF_SMALL).collect()} == want


def test_equal_rows_keep_one_copy(spark):
    """Rows equal in id and text, also without ids: one keeps its text."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 99999, 60)) for _ in range(3)]
    rows = [(None, texts[0])] * 40 + [(7, texts[1])] * 3 + [(8, texts[2]), (9, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = substrings.removals(docs).collect()
    assert len(found) == len(rows) and Counter(r["text"] for r in found if r["text"]) == Counter(texts)
    assert all(bool(r["text"]) == (r["removed_chars"] == 0) for r in found)
    kept = substrings.deduplicate(docs).collect()
    assert Counter(tuple(r) for r in kept) == Counter([(None, texts[0]), (7, texts[1]), (8, texts[2])])


def test_substring_edges(edges, empty):
    assert substrings.removals(edges).count() == len(EDGES)
    kept = substrings.deduplicate(edges)
    assert kept.columns == edges.columns and kept.count() == len(EDGES)
    assert substrings.removals(empty).count() == 0 and substrings.deduplicate(empty).count() == 0


# 5: sharding

def brute_shards(rows):
    rows = sorted((hashlib.md5((t or "").encode()).digest(), d is not None, d, len((t or "").encode()) + 16) for d, t in rows)
    total, start, at, groups = sum(r[3] for r in rows), [], 0, defaultdict(list)
    for i, r in enumerate(rows):
        start.append(at)
        at += r[3]
        groups[r[0]].append(i)
    shard = []
    for i, r in enumerate(rows):
        g = groups[r[0]]
        whole = sum(rows[k][3] for k in g) * 8 * 40 <= total and len(g) > 1
        shard.append(min(39, (start[g[0]] if whole else start[i]) * 40 // total))
    return [(r[2], r[3], s, i - shard.index(s)) for i, (r, s) in enumerate(zip(rows, shard, strict=True))]


def test_shards_equal_brute_force(spark, real, edges, empty):
    rows = sharding.op5_byte_shards(spark, SF_SMALL).collect()
    assert sorted((r["doc_id"], r["size"], r["shard"], r["slot"]) for r in rows) == sorted(brute_shards(real[1].items()))
    assert all(zlib.crc32(real[1][r["doc_id"]].encode()) == r["text_crc32"] and r["law"] == "bytes" for r in rows)
    found = sharding.shard(edges).collect()
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert len(found) == len(EDGES) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(empty).count() == 0


def test_equal_rows_are_many_ranges(spark, monkeypatch):
    """A third of all rows equal in text and id: parts stay even, shards equal brute force."""
    rows = [(i, f"text {i % 1500} " * 3) for i in range(2000)] + [(None, "the same text again and again")] * 1000
    parts = []

    def seen(*args):
        parts.append(prefixsums.ranged(*args))
        return parts[-1]

    monkeypatch.setattr(sharding, "ranged", seen)
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    sizes = [r["count"] for r in parts[0].groupBy("part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.6 * len(rows) / 8

    def plain(rows):
        return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))

    assert plain((r["doc_id"], r["size"], r["shard"], r["slot"]) for r in found) == plain(brute_shards(rows))


# 6: classifier

def test_classifier_on_held_out_rows(spark, edges, empty):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in classifier.op6_subword_classifier(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [(r["quality"], rows[r["doc_id"]]["predicted"]) for r in labels if rows[r["doc_id"]]["held_out"]]
    assert len(rows) == 1000 and all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    assert np.mean([a == b for a, b in held]) > 0.9
    model = classifier.Model(np.linspace(-1, 1, 1 << classifier.BUCKET_BITS, dtype=np.float32), 0.25)
    scored = classifier.score(edges.select("doc_id", "text"), model).collect()
    assert len(scored) == len(EDGES) and all(0 <= r["score"] <= 1 for r in scored)
    assert len({r["score"] for r in scored if not r["text"]}) == 1
    assert classifier.accepted_documents(edges, model).columns == edges.columns
    assert classifier.score(empty.select("doc_id", "text"), model).count() == 0


def test_sample_size_is_the_same_for_every_class_size(spark):
    for n in (classifier.SAMPLE_PER_CLASS + 1, 10**6, 1_100_000_000, 3 * 10**9, 10**13):
        share = (classifier.sample_bar(n) + 1) / 2**63
        assert abs(n * share / classifier.SAMPLE_PER_CLASS - 1) < 1e-3
    assert classifier.sample_bar(1) == classifier.sample_bar(classifier.SAMPLE_PER_CLASS) == 2**63 - 1
    docs = spark.range(40_000).selectExpr("id as doc_id", "'x' as text")
    labels = docs.selectExpr("doc_id", "int(doc_id < 1500) as label")
    sizes = Counter(r["label"] for r in classifier.training_sample(docs, labels).collect())
    assert sizes[1] == 1500 and abs(sizes[0] - 2000) < 200


def test_classifier_without_usable_labels(spark, edges):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None)], "doc_id long, label int")
    model = classifier.train(edges, labels)
    assert {r["score"] for r in classifier.score(edges.select("doc_id", "text"), model).collect()} == {0.5}


# 7: URL rules

def test_url_rules_equal_brute_force(spark):
    rules = [("com", "/", "allow"), ("a.com", "/", "block"), ("a.com", "/x/", "allow"), ("a.com", "/x/y", "block"), ("b.a.com", "/x", "allow"),
             ("net", "", "block"), ("a.com", "/x/", "block")]
    hosts = ["com", "a.com", "A.com", "b.a.com", "c.b.a.com", "xa.com", "net", "n.net", ".net", "net.", "org", ""]
    urls = [None, "", "no scheme", "http://", "://com/", "x://y://com/"] + [f"http://{h}{p}" for h in hosts for p in ("", "/", "/x", "/x/", "/x/y?q=/x", "/x/yz#f", "/xx/")]
    pages = spark.createDataFrame([(i, u, None, i) for i, u in enumerate(urls)], "page_id long, url string, html string, key long")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    for r in urlfilters.judge(pages, table).collect():
        url, host, path = urls[r["page_id"]] or "", "", ""
        if "://" in url:
            rest = url.split("://", 1)[1]
            end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, path = rest[:end].lower(), rest[end:].split("?")[0].split("#")[0]
        fit = [(len(h) + len(p), len(h), h + p, {"a.com/x/": "allow"}.get(h + p, v)) for h, p, v in rules
               if (host == h or host.endswith("." + h)) and path.startswith(p) and "://" in url]
        best = max(fit, default=(0, 0, None, urlfilters.DEFAULT_VERDICT))
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, best[2], best[3]), url
    long = spark.createDataFrame([(1, "http://" + "a." * 20_000 + "a.com/x/"), (2, "http://" + "." * 20_000)], "page_id long, url string")
    assert [(r["page_id"], r["rule"]) for r in urlfilters.judge(long, table).orderBy("page_id").collect()] == [(1, "a.com/x/"), (2, None)]
    assert urlfilters.judge(pages.limit(0), table).count() == 0
    assert {r["verdict"] for r in urlfilters.judge(pages, table.limit(0)).collect()} == {"allow"}


# 8: token counts

def test_counts_equal_library(spark, real, edges, empty):
    t = tokenizer(BYTE_BPE)
    want = {d: len(t.encode(x, add_special_tokens=False).ids) for d, x in real[1].items()}
    rows = tokencounts.op8_token_counts(spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want
    assert all(r["n_bytes"] == len(real[1][r["doc_id"]].encode()) and r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)
    found = Counter((r["doc_id"], r["n_tokens"]) for r in tokencounts.count_tokens(edges, BYTE_BPE).collect())
    assert found == Counter((x[0], len(t.encode(x[1] or "", add_special_tokens=False).ids)) for x in EDGES)
    assert tokencounts.count_tokens(empty, BYTE_BPE).count() == 0


def test_counts_around_the_chunk_length(spark, real):
    """Texts a little shorter and longer than a chunk: spliced or in pieces, the library's counts."""
    t, spliced = tokenizer(BYTE_BPE), [x for x in real[1].values() if x and len(x) > tokencounts.CHUNK_CHARS]
    assert len(spliced) >= 5  # ordinary long documents are spliced
    whole = "\n".join(x for _, x in sorted(real[1].items()) if x)
    texts = [whole[at:at + tokencounts.CHUNK_CHARS + more] for at in range(0, 40_000, 5_003) for more in (-600, -1, 0, 1, 600, 9_000)]
    want = {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    assert {r["doc_id"]: r["n_tokens"] for r in tokencounts.count_tokens(docs, BYTE_BPE).collect()} == want
    for i, x in enumerate(texts):  # both paths on every text
        assert len(tokencounts.encode_long(lambda y: t.encode(y, add_special_tokens=False), x)) == want[i]


def test_overlaps_resynchronise():
    t = tokenizer(BYTE_BPE)

    def encode(x):
        return t.encode(x, add_special_tokens=False)

    rng = np.random.default_rng(2)
    parts = ["a", "Z", " ", "  ", "\n", "é", "日本", "😀", "'s", "<|endoftext|>", "<|endo", "12", "!!", "\u00a0", "x" * 50, " " * 40]
    texts = ["".join(rng.choice(parts, 150)) for _ in range(150)] + ["a" * 3000, "日" * 1000, " " * 3000, "<|endoftext|>" * 200]
    for text in texts:
        for chunk, overlap, guard in ((100, 10, 16), (64, 4, 15)):
            assert tokencounts.encode_long(encode, text, chunk, overlap, guard) == encode(text).ids


# 9: packing

def check_packing(rows, texts):
    t, pieces, bins = tokenizer(WORD_BPE), defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append(r)
    for d, text in texts.items():
        ids, at = np.array([*t.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4"), 0
        for r in sorted(pieces[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:at].tobytes())
        assert at == len(ids)
    padding = 0
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    return padding


def test_packing_is_whole_and_tight(spark, real, edges, empty):
    rows = packing.op9_harmonic_packing(spark, SF_SMALL).collect()
    assert check_packing(rows, real[1]) < 0.02 * sum(r["length"] for r in rows)
    one_each = edges.filter("doc_id is not null").dropDuplicates(["doc_id"])
    check_packing(packing.pack(one_each, WORD_BPE).collect(), {r["doc_id"]: r["text"] for r in one_each.collect()})
    assert packing.pack(edges, WORD_BPE).filter("start = 0").count() == len(EDGES)
    assert packing.pack(empty, WORD_BPE).count() == 0


def test_ids_of_pieces_equal_library():
    """Words are cut at letters and marks and lower-cased before the library sees them: the ids stay its own."""
    t, rng = tokenizer(WORD_BPE), np.random.default_rng(9)
    parts = ["a", "Z", "Word", " ", "\n", "\u00a0", "é", "É", "×", "÷", "ß", "İ", "日本", "😀", "'s", "'S", "'", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>",
             "<|Endo", "|", "12", "7", ".", "!!", "(", "=", "H", "h", "K", "\u0331", "\u0338", "\u0301", "\u20e3", "Σ", "-'s", "\x00", "\u200d"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 60))) for _ in range(3000)]
    texts += [a + b + c for a in parts for b in parts for c in ("", ".", "H", "\u0331")]
    ids, off = packing.token_ids(Texts.of(texts), WORD_BPE)
    for i, text in enumerate(texts):
        assert ids[off[i]:off[i + 1]].tolist() == [*t.encode(text, add_special_tokens=False).ids, packing.END_ID], repr(text)


def test_rests_are_cut_into_classes():
    for rest in range(1, packing.CAPACITY):
        parts = packing.split_rest(rest)
        assert sum(n for n, _ in parts) == rest and all(packing.CAPACITY // n >= j and packing.CAPACITY - j * n <= max(packing.SLACK, j) for n, j in parts)


# 10: near-duplicates

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance_equals_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(800):
        a = rng.integers(0, 4, rng.integers(1, 14))
        b = np.delete(a, rng.integers(0, len(a))) if len(a) > 1 and rng.random() < 0.5 else rng.integers(0, 4, rng.integers(1, 14))
        most, want = int(rng.integers(0, 14)), distance(list(a), list(b))
        assert nearduplicates.banded_distance(a, b, most) == (want if want <= most else None)


def test_classes_equal_brute_force(spark):
    """Planted groups among clean texts: classes are the components of all pairs that verify."""
    rng = np.random.default_rng(9)
    texts = []
    for g in range(8):
        base = [f"w{x}" for x in rng.integers(0, 500, 150 + 40 * g)]
        for copy in range(6 if g < 5 else 1):
            words = list(base)
            for _ in range(copy if g % 2 else 2 * copy):
                words[rng.integers(0, len(words))] = f"n{rng.integers(0, 99999)}"
            texts.append(" ".join(words))
    texts += [texts[0], texts[0].upper(), "too short", "too short", "", None]
    docs = spark.createDataFrame([(i + 100, t, i) for i, t in enumerate(texts)], "doc_id long, text string, content long")
    words = []
    for t in texts:
        one = Texts.of([(t or "").lower()])
        starts, ends, _ = one.words()
        words.append(nearduplicates.span_hashes(one.byte_prefix(), starts, ends))
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            a, b = words[i], words[j]
            same = (texts[i] or "") == (texts[j] or "")
            if same or (len(a) and len(b) and nearduplicates.similar(a, b) >= 0.8):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    rows = {r["doc_id"]: r for r in nearduplicates.near_duplicate_classes(docs).collect()}
    assert {d: r["class_id"] for d, r in rows.items()} == {i + 100: r + 100 for i, r in enumerate(root)}
    assert all(r["class_size"] == root.count(r["class_id"] - 100) for r in rows.values())
    kept = nearduplicates.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted({r + 100 for r in root})


def test_pairs_inside_a_template_family(spark):
    """Texts that share three quarters of their words with all others, among them
    pairs of a similarity a little above the bar: every pair is one class."""
    rng = np.random.default_rng(31)
    template = [f"t{i}" for i in range(150)]
    texts = []
    for pair in range(200):
        own = [f"o{pair}x{i}" for i in range(50)]
        other = list(own)
        for at in rng.choice(4, 3, replace=False):
            other[6 + 12 * at] = f"c{pair}x{at}"
        texts += [" ".join(template + own), " ".join(template + other)]
    one = Texts.of(texts[:4])
    starts, ends, first = one.words()
    words = np.split(nearduplicates.span_hashes(one.byte_prefix(), starts, ends), first[1:-1])
    assert 0.8 <= nearduplicates.similar(words[0], words[1]) < 0.87 and nearduplicates.similar(words[0], words[2]) == 0
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in nearduplicates.near_duplicate_classes(docs).collect()}
    assert {d: (r["class_id"], r["class_size"]) for d, r in rows.items()} == {d: (d - d % 2, 2) for d in range(400)}


@pytest.mark.parametrize("light", [0, 1, 4])
def test_exact_join_equals_brute_force(spark, light, monkeypatch):
    """All pairs at the window similarity, from texts of many lengths with shared
    passages; also when every key is split in each round."""
    monkeypatch.setattr(nearduplicates, "LIGHT", light)
    rng = np.random.default_rng(32)
    base = [f"b{x}" for x in rng.integers(0, 300, 120)]
    texts = ["one two", "one two three", "alone"]
    for i in range(150):
        words = list(base[:int(rng.integers(20, 120))])
        for _ in range(int(rng.integers(0, 4))):
            words[rng.integers(0, len(words))] = f"n{i}"
        texts.append(" ".join(words + [f"e{i}x{k}" for k in range(int(rng.integers(0, 12)))]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = docs.select(nearduplicates.content_key(docs["text"]).alias("content"))
    words = nearduplicates.word_sequences(docs, keyed.distinct()).cache()
    none = spark.createDataFrame([], "a struct<x: long, y: long>, b struct<x: long, y: long>")
    found = {(tuple(r["a"]), tuple(r["b"])) for r in nearduplicates.exact_pairs(words, keyed.distinct(), none).collect()}
    held = sorted(((tuple(r["content"]), np.frombuffer(r["words"], np.uint64)) for r in words.collect()), key=lambda r: r[0])
    want = {(held[i][0], held[j][0]) for j in range(len(held)) for i in range(j)
            if nearduplicates.shared_windows(held[i][1], held[j][1]) >= 0.8}
    assert len(want) > 100 and want <= found and len(found) < 2 * len(want)


def test_texts_of_common_passages_are_not_squared(spark):
    """Every text is put together from common passages and has no window of its own:
    the pairs that are left to compare grow with the texts."""
    rng = np.random.default_rng(33)
    passages = [" ".join(f"p{i}x{k}" for k in range(30)) for i in range(40)]
    texts = {" ".join(passages[i] for i in sorted(rng.choice(40, 8, replace=False))) for _ in range(400)}
    texts |= {t.replace("x7 ", "y7 ", 1) for t in sorted(texts)[:20]}  # one word changed in some
    docs = spark.createDataFrame(list(enumerate(sorted(texts))), "doc_id long, text string")
    keyed = docs.select(nearduplicates.content_key(docs["text"]).alias("content")).distinct()
    words = nearduplicates.word_sequences(docs, keyed).cache()
    none = spark.createDataFrame([], "a struct<x: long, y: long>, b struct<x: long, y: long>")
    found = {(tuple(r["a"]), tuple(r["b"])) for r in nearduplicates.exact_pairs(words, keyed, none).collect()}
    held = sorted(((tuple(r["content"]), np.frombuffer(r["words"], np.uint64)) for r in words.collect()), key=lambda r: r[0])
    want = {(held[i][0], held[j][0]) for j in range(len(held)) for i in range(j)
            if nearduplicates.shared_windows(held[i][1], held[j][1]) >= 0.8}
    assert len(want) >= 20 and want <= found and len(found) < 10 * len(held)


def test_near_duplicate_edges(edges, empty):
    rows = nearduplicates.near_duplicate_classes(edges).collect()
    assert len(rows) == len(EDGES)
    blank = {r["class_id"] for r in rows if r["doc_id"] in (2, 3)}
    assert blank == {2}
    assert nearduplicates.deduplicate(edges).count() == 8  # two rows repeat, two more texts are empty
    assert nearduplicates.near_duplicate_classes(empty).count() == 0 and nearduplicates.deduplicate(empty).count() == 0
