"""Near-duplicates by Order MinHash (operator 10).

The k-mers are windows of five lower-cased words, labelled with their
occurrence number within the text.  Each sketch takes the few least labelled
k-mers under its own hash order and keeps them in text order, so two texts
agree on a sketch only when they share those k-mers in the same order.  Texts
that agree on a sketch meet in a bucket, and texts that agree on two or four
neighbouring sketches also in a finer bucket.  Each bucket's members are
compared with one hub, the member that meets most others over all its buckets,
so candidates grow with the rows and not with the square of a bucket.  Where a
member does not match its hub, the bucket meets further hubs.  The texts of the
buckets that are still not of one class after PASSES hubs are joined exactly: no
pair of them that reaches the window similarity and is not in one class yet is
left out.  They meet on rare five-word windows (see ``exact_pairs``).  A candidate
is a link when

* the sets of their five-word windows have a Jaccard similarity of at least 0.8, and
* a banded alignment of their words gives an edit similarity of at least 0.8.

Classes are the connected components of the links.  Equal texts are one text
throughout: they are joined by content hash before anything else.

The candidate search is probabilistic: a pair at similarity 0.8 agrees on one
given sketch with probability of about one half, and on none of the 16 with
about one in 10^5.

Edge cases: a null text is empty; all empty texts are one class; a text of one
to four words has one k-mer of all its words; a text without words is linked
only to equal texts.  Null ``doc_id`` rows take part; a class's id is its
least ``doc_id`` (null when it has none).  Repeated rows are equal texts.  An
empty table gives an empty result; extra columns pass through ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty, write_scratch
from .components import components
from .textarrays import Texts, lean, mix, prefix_sums, row_of, slices, span_hashes, word_windows

#: Words of a k-mer; sketches; k-mers that a sketch samples; least similarity of a link.
KMER_WORDS, SKETCHES, SAMPLED, SIMILARITY = 5, 16, 3, 0.8
#: Neighbouring sketches that the coarse and the finer buckets agree on.
LEVELS = (1, 2, 4)
#: Hubs that the members of a bucket meet, one after the other, while some do not match.
PASSES = 3

#: Least window counts of the length bands of the exact join: a band spans about 5 %.
BANDS = np.unique(np.ceil(1.05 ** np.arange(500)).astype(np.int64))
#: Pairs for each member beyond which a key of the exact join is split; rounds of splitting.
LIGHT, SPLITS = 64, 2
#: Rows of the exact join that a task holds before it gives them on.
PREFIX_ROWS = 1 << 16

_U = np.uint64
_MAX = _U(0xFFFFFFFFFFFFFFFF)
_ORDERS = mix(np.arange(1, SKETCHES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


def labelled_kmers(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all occurrence-labelled k-mers in text order, and where each text's begin."""
    starts, ends, first = texts.words()
    words = span_hashes(texts.byte_prefix(), starts, ends)
    n_words = np.diff(first)
    at, window = word_windows(words, first, KMER_WORDS)
    short = np.flatnonzero((n_words > 0) & (n_words < KMER_WORDS))
    if len(short):
        whole = span_hashes(prefix_sums(words), first[short], first[short + 1])
        at, window = np.concatenate([at, first[short]]), np.concatenate([window, whole])
        order = np.argsort(at, kind="stable")
        at, window = at[order], window[order]
    begin = np.searchsorted(at, first)
    key = mix(window + mix(row_of(begin) + 1))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    place = np.arange(len(key))
    number = np.empty(len(key), np.int64)
    number[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return mix(window + number.astype(_U) * _U(0xC2B2AE3D27D4EB4F)), begin


def sketches(texts: Texts) -> np.ndarray:
    """Order MinHash sketches: one row per text, 0 throughout for a text without words."""
    kmers, begin = labelled_kmers(texts)
    out = np.zeros((texts.n, SKETCHES), _U)
    filled = np.flatnonzero(np.diff(begin))
    if not len(filled):
        return out
    at, row = begin[filled], np.repeat(np.arange(len(filled)), np.diff(begin)[filled])
    for j in range(SKETCHES):
        order = (kmers ^ _ORDERS[j]) * _ORDERS[(j + 1) % SKETCHES]
        picks = np.full((len(filled), SAMPLED), len(kmers), np.int64)
        for k in range(SAMPLED):
            least = np.minimum.reduceat(order, at)
            hit = np.flatnonzero(order == least[row])
            hit = hit[order[hit] != _MAX]
            picks[row[hit[::-1]], k] = hit[::-1]
            order[hit] = _MAX
        picks.sort(axis=1)
        sketch = np.full(len(filled), _ORDERS[j], _U)
        padded = np.append(kmers, _U(0))
        for k in range(SAMPLED):
            sketch = mix(sketch + padded[picks[:, k]])
        out[filled, j] = sketch
    return out


def content_key(text: Column) -> Column:
    """Two 64-bit hashes that stand for a text's content."""
    return F.struct(F.xxhash64(text).alias("x"), F.xxhash64(text, F.lit(1)).alias("y"))


def sketch_documents(docs: DataFrame) -> DataFrame:
    """``content`` and ``sketch`` (array of longs) of every document with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = sketches(Texts(batch.column("text"))).view(np.int64)
            some = np.flatnonzero(found.any(axis=1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * SKETCHES, pa.int32()), pa.array(found[some].ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("content").take(pa.array(some)), lists], ["content", "sketch"])

    docs = docs.select(content_key(text_or_empty()).alias("content"), F.lower(text_or_empty()).alias("text"))
    return docs.mapInArrow(lean(run), "content struct<x: long, y: long>, sketch array<long>")


def shared_buckets(sketched: DataFrame) -> DataFrame:
    """``(bucket, content)`` of every bucket with two members or more.
    ``sketched`` has one row per content."""
    found, rows = None, sketched
    for level in LEVELS:
        keys = F.array(*[F.xxhash64(F.lit(level), F.lit(j), *[F.col("sketch")[(j + i) % SKETCHES] for i in range(level)])
                         for j in range(SKETCHES)])
        bucketed = rows.select("content", F.explode(keys).alias("bucket"))
        sizes = bucketed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
        shared = write_scratch(bucketed.join(sizes, "bucket"), f"buckets-{level}")
        found = shared if found is None else found.unionByName(shared)
        # only texts that share a coarse bucket can share a finer one
        rows = rows.join(shared.select("content").distinct(), "content", "left_semi")
    return found


def ranked_members(shared: DataFrame) -> DataFrame:
    """``(bucket, content, met)``: with every member the number of texts that it
    meets over all its buckets.  The hub of a bucket is its member that meets most."""
    sizes = shared.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    meets = shared.join(sizes, "bucket").groupBy("content").agg(F.sum("n").alias("met"))
    return shared.join(meets, "content").select("bucket", "content", "met")


def shared_windows(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of the sets of five-word windows of two word sequences."""
    def windows(words):
        size = min(KMER_WORDS, len(words))
        first = np.array([0, len(words)])
        return np.unique(word_windows(words, first, size)[1])

    x, y = windows(a), windows(b)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def banded_distance(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edit distance of two sequences if it is at most ``most``, else None.
    Furthest-reaching alignment on the diagonals within ``most`` of the main one."""
    same = 0
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    same = int(differ[0]) if len(differ) else n
    a, b = a[same:], b[same:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n:][::-1] != b[len(b) - n:][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not len(a) or not len(b):
        return max(len(a), len(b)) if max(len(a), len(b)) <= most else None
    stops: dict[int, np.ndarray] = {}

    def slide(k: int, i: int) -> int:
        """From a[i], b[i + k] along equal words."""
        if k not in stops:
            lo, hi = max(0, -k), min(len(a), len(b) - k)
            wrong = np.full(len(a) + 1, hi, np.int64)
            if hi > lo:
                at = np.where(a[lo:hi] != b[lo + k:hi + k], np.arange(lo, hi), hi)
                wrong[lo:hi] = np.minimum.accumulate(at[::-1])[::-1]
            stops[k] = wrong
        return int(stops[k][i])

    goal = len(b) - len(a)
    if abs(goal) > most:
        return None
    reach = {0: slide(0, 0)}
    if goal == 0 and reach[0] >= len(a):
        return 0
    for edits in range(1, most + 1):
        after = {}
        for k in range(-edits, edits + 1):
            if abs(goal - k) > most - edits or k > len(b) or -k > len(a):
                continue  # the end diagonal is out of reach from here
            i = max(reach.get(k, -2) + 1, reach.get(k - 1, -1), reach.get(k + 1, -2) + 1)
            if i < max(0, -k):
                continue
            after[k] = slide(k, min(i, len(a), len(b) - k))
        reach = after
        if reach.get(goal, -1) >= len(a):
            return edits
    return None


def similar(a: np.ndarray, b: np.ndarray) -> float:
    """The verified similarity of two word sequences: the lesser of window and
    edit similarity, or 0 when either is below the threshold."""
    if min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
        return 0.0
    windows = shared_windows(a, b)
    if windows < SIMILARITY:
        return 0.0
    longest = max(len(a), len(b))
    distance = banded_distance(a, b, int((1 - SIMILARITY) * longest))
    return 0.0 if distance is None else min(windows, 1 - distance / longest)


def word_sequences(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``content`` and ``words`` (64-bit word hashes in text order) of each wanted content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = Texts(batch.column("text"))
            starts, ends, first = texts.words()
            words = span_hashes(texts.byte_prefix(), starts, ends).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array([words[8 * i:8 * j] for i, j in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                ["content", "words"])

    # one row stands for all copies of a content.  The semi join moves the texts of all
    # documents, spread by content and id; only rows equal in both meet in one task
    content = content_key(text_or_empty()).alias("content")
    firsts = docs.select(content, "doc_id").join(wanted, "content").groupBy("content").agg(F.min("doc_id").alias("doc_id"))
    texts = docs.select(content, "doc_id", F.lower(text_or_empty()).alias("text"))
    same = (texts["content"] == firsts["content"]) & texts["doc_id"].eqNullSafe(firsts["doc_id"])
    chosen = texts.join(firsts, same, "left_semi").mapInArrow(lean(run), "content struct<x: long, y: long>, words binary")
    return chosen.dropDuplicates(["content"])


def word_views(column: pa.Array) -> Iterator[np.ndarray]:
    """The word hashes of each row of a binary column, without copies of the column."""
    held = Texts(column)
    for lo, hi in zip(held.off[:-1], held.off[1:], strict=True):
        # a copy of one row: its place in the buffer need not be a multiple of eight
        yield np.frombuffer(held.buf[lo:hi].tobytes(), _U)


def verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that are links, with their similarity."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (word_views(batch.column(c)) for c in ("words_a", "words_b"))
            score = np.array([similar(x, y) for x, y in zip(a, b, strict=True)], float)
            keep = pa.array(score >= SIMILARITY)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep),
                                              pa.array(score).filter(keep)], ["a", "b", "similarity"])

    joined = (pairs.join(words.select(F.col("content").alias("a"), F.col("words").alias("words_a")), "a")
              .join(words.select(F.col("content").alias("b"), F.col("words").alias("words_b")), "b"))
    return joined.mapInArrow(lean(verify), "a struct<x: long, y: long>, b struct<x: long, y: long>, similarity double")


def window_sets(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every distinct window that ``shared_windows`` compares, by text."""
    at, window = word_windows(words, first, KMER_WORDS)
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < KMER_WORDS))
    row = np.concatenate([row_of(first)[at], short])
    window = np.concatenate([window, span_hashes(prefix_sums(words), first[short], first[short + 1])])
    order = np.lexsort((window, row))
    row, window = row[order], window[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (window[1:] != window[:-1])
    return row[new], window[new]


def window_rows(words: DataFrame) -> DataFrame:
    """``(content, n, window)``: the distinct windows of every content, and how many they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words"):
            sequences = Texts(batch.column("words"))
            row, window = window_sets(np.frombuffer(sequences.buf.tobytes(), _U), sequences.off // 8)
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("content").take(rows), pa.array(np.bincount(row, minlength=sequences.n)[row].astype(np.int32)),
                 pa.array(window.view(np.int64))], ["content", "n", "window"])

    return words.select("content", "words").mapInArrow(lean(run), "content struct<x: long, y: long>, n int, window long")


def prefixes(n: int) -> list[tuple[int, int, int]]:
    """Own band, other band and prefix length of a set of ``n`` windows: two sets
    that reach SIMILARITY have a window of both prefixes in common, whatever the
    order in which both are sorted."""
    least, most = int(np.ceil(SIMILARITY * n - 1e-9)), int(n / SIMILARITY + 1e-9)
    own, lowest, highest = (int(b) for b in np.searchsorted(BANDS, [n, least, most], "right") - 1)
    out = []
    for other in range(lowest, highest + 1):
        size = max(int(BANDS[other]), least)
        overlap = int(np.ceil(SIMILARITY / (1 + SIMILARITY) * (n + size) - 1e-9))
        out.append((own, other, n - overlap + 1))
    return out


def prefix_rows(ranked: DataFrame) -> DataFrame:
    """``(key, window, place, low, high)`` of the windows of every prefix that other
    contents of the group have too, with ``group``, ``content``, ``root`` and ``n``.
    ``ranked`` holds a content's shared windows in the group's order, rarest first;
    the ones of its own come before them.  ``key`` is the window with the group and
    the two bands; ``low`` and ``high`` tell which of them the content is in."""

    names, kept = ["key", "window", "place", "low", "high"], ["group", "content", "root", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(batch, index, parts):
            rows = pa.array(np.repeat(index, [len(p[0]) for p in parts]))
            columns = [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)]
            return pa.RecordBatch.from_arrays([*columns, *[batch.column(c).take(rows) for c in kept]], [*names, *kept])

        for batch in batches:
            index, parts, held = [], [], 0
            for i in range(batch.num_rows):
                n, windows = batch.column("n")[i].as_py(), batch.column("windows")[i].values.to_numpy().view(_U)
                group = mix(np.array([batch.column("group")[i].as_py()], np.int64).view(_U))
                alone = n - len(windows)
                for own, other, length in prefixes(n):
                    part = windows[:max(0, length - alone)]
                    if len(part):
                        bands = np.array([1 + min(own, other) * len(BANDS) + max(own, other)], _U)
                        index.append(i)
                        parts.append((mix(part + bands * _ORDERS[0] + group).view(np.int64), part.view(np.int64),
                                      np.arange(alone, alone + len(part), dtype=np.int32),
                                      np.full(len(part), own <= other), np.full(len(part), own >= other)))
                        held += len(part)
                if held > PREFIX_ROWS or (parts and i == batch.num_rows - 1):
                    yield out(batch, index, parts)
                    index, parts, held = [], [], 0

    pair = "struct<x: long, y: long>"
    return ranked.select(*kept, "windows").mapInArrow(
        lean(run), f"key long, window long, place int, low boolean, high boolean, group long, content {pair}, root {pair}, n int")


def _member_set(*columns: str) -> Column:
    """A fingerprint of the set of rows of a group, for rows that are distinct."""
    both = [F.sum(F.xxhash64(*columns, F.lit(i)).cast("decimal(38,0)")) for i in range(2)]
    return F.struct(F.count("*").alias("members"), *[c.alias(f"sum_{i}") for i, c in enumerate(both)])


def key_sizes(keyed: DataFrame) -> DataFrame:
    """``(key, group, window, heavy)`` of the keys in which members of different
    classes meet.  Of keys with the same members, the one that is first in their
    texts stands for all: a pair that shares one of them shares that one.  A key is
    heavy when it has more than LIGHT pairs for each member."""
    by_root = keyed.groupBy("key", "group", "window", "root").agg(
        F.sum(F.col("low").cast("long")).alias("low"), F.sum(F.col("high").cast("long")).alias("high"),
        F.sum("place").alias("place"), _member_set("content", "low", "high").alias("set"))
    keys = by_root.groupBy("key", "group", "window").agg(
        F.sum("low").alias("low"), F.sum("high").alias("high"), F.sum(F.col("low") * F.col("high")).alias("within"), F.sum("place").alias("place"),
        *[F.sum(f"set.{c}").alias(c) for c in ("members", "sum_0", "sum_1")])
    pairs = F.col("low") * F.col("high") - F.col("within")
    keys = keys.filter(pairs > 0).withColumn("heavy", pairs > LIGHT * F.col("members"))
    same = keys.groupBy("group", "members", "sum_0", "sum_1", "low", "high")
    return same.agg(F.min_by(F.struct("key", "window", "heavy"), F.struct("place", "key")).alias("k")).select(
        "k.key", "group", "k.window", "k.heavy")


def meeting_pairs(keyed: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of members of different classes that share a key and may share
    enough windows: those before the shared one are not shared."""
    names = ("content", "root", "n", "place", "high")
    a, b = (keyed.filter(side).select("key", *[F.col(c).alias(f"{c}_{x}") for c in names]) for side, x in (("low", "a"), ("high", "b")))
    sharable = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    able = sharable >= (F.col("n_a") + F.col("n_b")) * (SIMILARITY / (1 + SIMILARITY)) - 1e-6
    once = ~F.col("high_a") | (F.col("content_a") < F.col("content_b"))  # within one band both are low and high
    met = a.join(b, (a["key"] == b["key"]) & (F.col("root_a") != F.col("root_b")) & able & once)
    return met.select(F.least("content_a", "content_b").alias("a"), F.greatest("content_a", "content_b").alias("b")).distinct()


def exact_pairs(words: DataFrame, left: DataFrame, found: DataFrame) -> DataFrame:
    """All pairs ``(a, b)`` of the contents in ``left`` that can reach SIMILARITY in
    their windows and are not connected by ``found`` yet.

    Every text's windows are sorted by how many texts have them, so two similar
    texts share one among their rarest (prefix filter).  The prefix is as long as
    the lengths of the two ask for: a key is a window with the length bands of
    both.  The place of the first shared window bounds what two texts can share
    (positional filter).  Texts of one class are not compared with each other.

    A window that many texts of different classes have among their rarest (texts
    put together from common passages) makes a heavy key.  Its pairs are not
    formed: its texts become a group, in which windows are counted and sorted anew.
    What all of them share now comes last, and what tells them apart comes first,
    so the prefixes of the group meet on other windows, in smaller groups, which
    may be split again.  Any order of the windows is right for the prefix filter,
    so no pair is lost.  After SPLITS rounds what is still heavy is joined as it
    is: texts that have nearly all windows in common."""
    rooted = components(found.select("a", "b"))
    windows = window_rows(words.join(left, "content", "left_semi"))
    windows = write_scratch(windows.join(rooted, windows["content"] == rooted["node"], "left").select(
        "content", "n", "window", F.coalesce("root", "content").alias("root")), "windows")
    rows, pairs = windows.withColumn("group", F.lit(0).cast("long")), None
    for split in range(SPLITS + 1):
        counts = rows.groupBy("group", "window").agg(F.count("*").alias("texts")).filter("texts > 1")
        ranked = (rows.join(counts, ["group", "window"]).groupBy("group", "content", "root", "n")
                  .agg(F.array_sort(F.collect_list(F.struct("texts", "window")))["window"].alias("windows"))
                  .filter(F.col("n") - F.size("windows") <= F.col("n") * (1 - SIMILARITY) + 1e-6))
        keyed = write_scratch(prefix_rows(ranked), "prefixes")
        sizes = write_scratch(key_sizes(keyed), "key-sizes")
        light = sizes if split == SPLITS else sizes.filter("not heavy")
        met = write_scratch(meeting_pairs(keyed.join(light.select("key"), "key", "left_semi")), "meeting")
        pairs = met if pairs is None else pairs.unionAll(met)
        heavy = sizes.filter("heavy").select("group", "window").distinct()
        if split == SPLITS or heavy.isEmpty():
            return pairs.distinct()
        members = write_scratch(keyed.join(heavy, ["group", "window"], "left_semi").select("group", "window", "content").distinct(), "heavy")
        sets = members.groupBy("group", "window").agg(_member_set("content").alias("set"))
        chosen = sets.groupBy("set").agg(F.min(F.struct("group", "window")).alias("w")).select("w.group", "w.window")
        groups = members.join(chosen, ["group", "window"], "left_semi").select(F.xxhash64("group", "window").alias("group"), "content")
        rows = write_scratch(groups.join(windows, "content").select("group", "content", "n", "window", "root"), "group-windows")


def links(docs: DataFrame) -> DataFrame:
    """Verified links ``(a, b, similarity)`` between contents.  In each pass all
    members of a bucket meet its next hub; a bucket whose members all match their
    hub is done.  The members of the buckets left after the passes are joined exactly."""
    sketched = write_scratch(sketch_documents(docs).dropDuplicates(["content"]), "sketches")
    shared = write_scratch(shared_buckets(sketched), "buckets")
    words = write_scratch(word_sequences(docs, shared.select("content").distinct()), "words")
    members = write_scratch(ranked_members(shared).withColumn("was_hub", F.lit(False)), "members")
    found = tested = None
    for _ in range(PASSES):
        hubs = members.filter("not was_hub").groupBy("bucket").agg(F.max(F.struct("met", "content"))["content"].alias("hub"))
        meeting = members.join(hubs, "bucket")
        pair = (F.least("content", "hub").alias("a"), F.greatest("content", "hub").alias("b"))
        pairs = meeting.filter("content <> hub").select(*pair).distinct()
        pairs = write_scratch(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        passed = write_scratch(verified(pairs, words), "verified")
        tested = pairs if tested is None else tested.unionAll(pairs)
        found = passed if found is None else found.unionAll(passed)
        unmatched = (meeting.filter("content <> hub").select("bucket", *pair)
                     .join(found.select("a", "b"), ["a", "b"], "left_anti").select("bucket").distinct())
        members = write_scratch(meeting.join(unmatched, "bucket", "left_semi").select(
            "bucket", "content", "met", (F.col("was_hub") | (F.col("content") == F.col("hub"))).alias("was_hub")), "members")
    # a hub has met all members of its bucket, so only pairs of others are still untested
    untested = members.filter("not was_hub")
    open_buckets = untested.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    left = write_scratch(untested.join(open_buckets, "bucket", "left_semi").select("content").distinct(), "untested")
    if left.isEmpty():
        return found
    pairs = exact_pairs(words, left, found)
    pairs = write_scratch(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
    return found.unionAll(write_scratch(verified(pairs, words), "verified"))


def classes(docs: DataFrame) -> DataFrame:
    """``(content, class_id, class_size, keeper)`` of every distinct content: its
    class, the class's number of documents, and whether it is the kept content."""
    members = write_scratch(docs.groupBy(content_key(text_or_empty()).alias("content"))
                            .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")), "contents")
    roots = components(links(docs).select("a", "b"))
    rooted = members.join(roots, members["content"] == roots["node"], "left").select(
        "content", "doc_id", "copies", F.coalesce("root", "content").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"),
                                        F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "content")).alias("first"))
    return rooted.join(groups, "root").select("content", "class_id", "class_size",
                                              (F.col("content") == F.col("first.content")).alias("keeper"))


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (the least ``doc_id`` of its
    class) and ``class_size``; a document alone in its class has size 1."""
    keyed = docs.select("doc_id", content_key(text_or_empty()).alias("content"))
    return keyed.join(classes(docs).drop("keeper"), "content").select("doc_id", "class_id", "class_size")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the least ``doc_id`` (of equal
    texts with equal ids, one), with all its columns."""
    kept = classes(docs).filter("keeper").select("content", F.col("class_id").alias("keeper_id"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("own_id"), content_key(text_or_empty()).alias("content"))
    same = (keyed["content"] == kept["content"]) & keyed["own_id"].eqNullSafe(kept["keeper_id"])
    chosen = keyed.join(kept, same, "left_semi")
    # the same text under the same id may stand in several rows
    return chosen.dropDuplicates(["content"]).select("row.*")


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"))
