"""Harmonic packing (operator 9).

Lengths are dealt into reciprocal-capacity classes: class j takes pieces of
more than CAPACITY / (j + 1) and at most CAPACITY / j tokens, and a sequence of
class j holds exactly j of them.  A document of more than CAPACITY tokens gives
full sequences first.  The rest goes whole into its class when j pieces of that
length leave at most SLACK tokens of a sequence empty; otherwise a piece of
exactly CAPACITY / (j + 1) is cut off for the next class, and so on with what is
left.

Filling needs no search: a task numbers its pieces of each class, a prefix sum
over (task, class) counts makes the numbers global, and number r of class j
lies in the class's sequence r / j.  The pieces of a class that do not fill a
sequence (fewer than j for each class, whatever the input) are cut into powers
of two and packed in the classes of those lengths; a last sequence there is a
power of two long, or is split by the binary digits of its count into ones that
are, and such sequences need no padding.

Edge cases: a null text is empty and has the end token alone; equal rows are
packed each; an empty table gives an empty result; a document of any length is
tokenized in pieces of words, so memory is bounded by its ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, write_scratch
from .textarrays import Texts, counts_between, lean, row_of, slices
from .tokenizer_files import piece_encoder, vocabulary

#: Tokens of a sequence; the id that ends each document; tokens of a sequence that may stay empty.
CAPACITY, END_ID, SLACK = 4096, 2, 24

#: ASCII letters, and ASCII marks but for the apostrophe and the bar.
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[b for b in range(128) if chr(b).isalpha()]] = True
_MARK[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in "'|"]] = True


def split_rest(rest: int) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a rest below CAPACITY."""
    out = []
    while rest:
        j = CAPACITY // rest
        if CAPACITY - j * rest <= SLACK:
            out.append((rest, j))
            break
        length = CAPACITY // (j + 1)
        out.append((length, j + 1))
        rest -= length
    return out


def binary_lengths(n: int) -> list[int]:
    """The powers of two that make up ``n``, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pretoken_pieces(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces that words are cut into, and the piece at
    which each text begins.  The pre-tokenizer ends a run of letters at a mark and
    a run of marks at a letter whatever stands around them, so words are cut there:
    fewer distinct pieces.  An apostrophe may lead a contraction, and ``|`` stands
    inside the special strings, so nothing is cut beside these.

    A-Z in ``texts`` are lower-cased, as the vocabulary's normaliser does, but for
    pieces with ``|`` (a special string is matched before that) and letters that a
    combining character may follow (it composes them first)."""
    buf = texts.buf
    letter, mark = _LETTER[buf], _MARK[buf]
    latin = letter.copy()
    latin[1:] |= (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)  # accented letters, without the two signs among them
    cut = np.zeros(len(buf) + 1, bool)
    cut[1:-1] = (latin[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    starts, ends, _ = texts.words()
    begins, stops = cut.copy(), cut
    begins[starts] = True
    stops[ends] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    as_is = np.zeros(len(buf) + 1, np.int8)
    kept = counts_between(buf == ord("|"), np.append(starts, len(buf))) > 0 if len(starts) else np.zeros(0, bool)
    as_is[starts[kept]] += 1
    as_is[ends[kept]] -= 1
    upper = (buf >= ord("A")) & (buf <= ord("Z")) & (np.cumsum(as_is[:-1], dtype=np.int8) == 0)
    upper[:-1] &= buf[1:] < 0x80
    texts.buf = np.where(upper, buf + np.uint8(32), buf)
    return starts, ends, np.searchsorted(starts, texts.off)


def token_ids(texts: Texts, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, each ended by END_ID, and where each text's begin."""
    starts, ends, first = pretoken_pieces(texts)
    pool, begin, end = piece_encoder(path).pieces(texts, starts, ends)
    size = end - begin
    per_text = np.bincount(row_of(first), weights=size, minlength=texts.n).astype(np.int64) + 1
    off = np.concatenate([[0], np.cumsum(per_text)])
    ids = np.full(off[-1], END_ID, np.int32)
    # the ids of word w go to its place among all words, moved on by the end ids before it
    place = np.cumsum(size) - size + row_of(first)
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    ids[np.repeat(place, size) + step] = pool[np.repeat(begin, size) + step]
    return ids, off


_REST: dict[int, list[tuple[int, int]]] = {}


def cut_pieces(docs: DataFrame, path: str) -> DataFrame:
    """The pieces of every document with their class and their number in it
    within the task (``part``).  ``powers`` holds the checksums of a piece's
    powers of two, should it be cut further."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, numbers = TaskContext.get().partitionId(), np.zeros(CAPACITY + 1, np.int64)
        for batch in slices(batches):
            ids, off = token_ids(Texts(batch.column("text")), path)
            raw = memoryview(ids.astype("<u4").tobytes())
            rows, start, length, kind, number, crc, powers = [], [], [], [], [], [], []
            for i in range(len(off) - 1):
                lo, n = int(off[i]), int(off[i + 1] - off[i])
                rest = n % CAPACITY
                if rest not in _REST:
                    _REST[rest] = split_rest(rest)
                at = 0
                for size, j in [(CAPACITY, 1)] * (n // CAPACITY) + _REST[rest]:
                    a = 4 * (lo + at)
                    rows.append(i)
                    start.append(at)
                    length.append(size)
                    kind.append(j)
                    number.append(numbers[j])
                    numbers[j] += 1
                    crc.append(zlib.crc32(raw[a:a + 4 * size]))
                    sums = []
                    if j > 1:
                        for p in binary_lengths(size):
                            sums.append(zlib.crc32(raw[a:a + 4 * p]))
                            a += 4 * p
                    powers.append(sums)
                    at += size
            index = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(index), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                pa.array(np.diff(off)).take(index), pa.array(kind, pa.int32()), pa.array(number, pa.int64()),
                pa.array(np.full(len(rows), part, np.int32)), pa.array(powers, pa.list_(pa.int64())),
            ], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "number", "part", "powers"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lean(run, tokenizers=True), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, class int, number long, part int, powers array<long>")


def pack(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and ``padded_length``."""
    pieces = write_scratch(cut_pieces(docs, path), "pieces")

    # global numbers of the pieces of each class, from the counts of each task; written,
    # as each use of them would count all pieces again
    counts = pieces.groupBy("class", "part").agg(F.count("*").alias("n"))
    of_class = Window.partitionBy("class")
    before = F.sum("n").over(of_class.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = write_scratch(counts.select("class", "part", F.coalesce(before, F.lit(0)).alias("shift"),
                                         F.sum("n").over(of_class).alias("total")).coalesce(16), "shifts")
    shift = shifts.select("class", "part", "shift")
    totals = shifts.select("class", "total").distinct()  # one row per class, at most CAPACITY
    numbered = (pieces.join(shift, ["class", "part"]).withColumn("number", F.col("number") + F.col("shift"))
                .join(F.broadcast(totals), "class"))
    in_full = F.col("number") < F.col("total") - F.pmod("total", "class")
    full = numbered.filter(in_full)

    # the rest of each class: powers of two, numbered within their length
    loose = numbered.filter(~in_full & (F.col("class") > 1))
    powers = F.array(*[F.lit(1 << b).cast("long") for b in range(CAPACITY.bit_length() - 2, -1, -1)])
    bits = F.filter(powers, lambda p: F.col("length").bitwiseAND(p) > 0)
    small = loose.select("*", F.posexplode(F.arrays_zip(bits.alias("size"), F.col("powers").alias("crc"))).alias("digit", "p"))
    small = small.select("doc_id", "doc_tokens", "class", "number", "digit", "p.size", F.col("p.crc").alias("ids_crc32"),
                         (F.col("start") + F.col("length") - F.col("length") % F.col("p.size") - F.col("p.size")).alias("start"))
    # fewer than one sequence's worth of tokens for each class: a bounded table, so one window per length
    by_size = Window.partitionBy("size").orderBy("class", "number", "digit")
    small = small.withColumn("n", F.row_number().over(by_size) - 1).withColumn("total", F.count("*").over(Window.partitionBy("size")))
    per = F.lit(CAPACITY) / F.col("size")
    small = small.withColumn("per", per.cast("long")).withColumn("whole", F.col("total") - F.col("total") % F.col("per"))
    # the pieces behind the last full sequence are split by the binary digits of their count
    left, at = F.col("total") - F.col("whole"), F.col("n") - F.col("whole")
    group = F.aggregate(
        F.filter(powers, lambda p: left.bitwiseAND(p) > 0),
        F.struct(F.lit(0).cast("long").alias("seen"), F.lit(-1).cast("long").alias("mine")),
        lambda acc, p: F.struct((acc["seen"] + p).alias("seen"),
                                F.when((acc["mine"] < 0) & (at < acc["seen"] + p), acc["seen"]).otherwise(acc["mine"]).alias("mine")))["mine"]
    tail = F.col("n") >= F.col("whole")
    small = small.withColumn("bin", F.when(tail, F.col("whole") + group).otherwise(F.col("n") - F.col("n") % F.col("per")))
    small = write_scratch(small.coalesce(16), "loose")

    # sequence ids: classes one after the other, then the powers of two
    base = F.sum(F.floor(F.col("total") / F.col("class"))).over(Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1))
    bases = write_scratch(totals.select("class", F.coalesce(base, F.lit(0)).cast("long").alias("base"),
                                        F.floor(F.col("total") / F.col("class")).alias("bins")), "bases")
    after = bases.agg(F.coalesce(F.sum("bins"), F.lit(0)).alias("after"))  # one row
    full = full.join(F.broadcast(bases.select("class", "base")), "class").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("base") + F.floor(F.col("number") / F.col("class"))).cast("long").alias("sequence_id"),
        F.pmod("number", "class").cast("long").alias("slot"))
    bins = small.select("size", "bin").distinct().withColumn(
        "rank", F.row_number().over(Window.orderBy("size", "bin")) - 1)  # a bounded table: see above
    small = small.join(bins, ["size", "bin"]).join(F.broadcast(after), F.lit(True)).select(
        "doc_id", "start", F.col("size").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("after") + F.col("rank")).cast("long").alias("sequence_id"), (F.col("n") - F.col("bin")).cast("long").alias("slot"))
    packed = full.unionByName(small)
    within = Window.partitionBy("sequence_id")
    so_far = F.sum("length").over(within.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))
    used = F.sum("length").over(within)
    power = used.bitwiseAND(used - 1) == 0
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(so_far, F.lit(0)).alias("offset"),
                         F.when(power, used).otherwise(F.lit(CAPACITY)).cast("long").alias("padded_length"))


def op9_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
