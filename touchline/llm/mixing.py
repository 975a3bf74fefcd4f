"""Mixing sources to target weights (operator 12): capped water-filling.

Every source asks for its share of the mix by weight.  A source cannot give
more than MOST_EPOCHS times its own size: it is clamped there, and what it
cannot give is dealt again over the others by weight, which may clamp more of
them, until none is above its cap.  All sources that are not clamped then
stand at one level (words for each unit of weight).  Each round needs only the
sums over clamped and free sources, so the driver holds a few numbers whatever
the number of sources.

A source whose target is e times its size gives every document floor(e) whole
repetitions.  The fractional repetition is a seeded sample: the source's
documents stand in the order of a seeded digest, and those of the first
(e - floor(e)) of its words are taken once more.  The document at the cut gives
its first words, so a source's taken words equal its rounded target.

The order is one range shuffle of (source, digest, row): a source that holds a
third of all rows fills many ranges.  Prefix sums come from per-range totals;
what a document must know of its source is joined by (range, source).  Native
DataFrame operations only; texts are not shuffled.

Edge cases: a null text or one without words has size 0 and gives nothing;
documents without a source are one source, the last one; null and repeated ids
are rows like others (rows equal in id, text and source may stand for each
other); when no document has a word all targets are 0; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, text_or_empty, write_scratch
from .prefixsums import before_parts, ranged

#: Weights of the sources in code point order, repeating; greatest use of a document; seed of the sample.
WEIGHTS, MOST_EPOCHS, SEED = (1, 2, 3), 3, "mix-1"

_SOURCE = ("no_source", "source")


def word_count(text: Column) -> Column:
    """How many words ``[^\\x20\\x09-\\x0D]+`` a text has: its word beginnings."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def sample_key(seed: str) -> Column:
    """Digest that orders a source's documents."""
    text = F.md5(text_or_empty().cast("binary"))
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text).cast("binary"))


def numbered_sources(rows: DataFrame) -> DataFrame:
    """One row per source: its size and its place in code point order, from 0."""
    sizes = rows.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"))
    parts = ranged(sizes, [F.col(c) for c in _SOURCE], "sources")
    shift = before_parts(parts, {"sources_before": F.count("*"), "words_before": F.sum("source_size")})
    order = Window.partitionBy("part").orderBy(*_SOURCE)
    words = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("source_size")
    return (parts.withColumn("nth", F.row_number().over(order) - 1).withColumn("words", words)
            .join(F.broadcast(shift), "part")  # one row per part
            .select(*_SOURCE, "source_size", (F.col("nth") + F.col("sources_before")).alias("place"),
                    (F.col("words") + F.col("words_before")).alias("source_start")))


def water_level(sources: DataFrame, most: int = MOST_EPOCHS) -> float:
    """The level at which the sources' targets, the lesser of cap and level times
    ``weight``, share all words.  Each round clamps the sources that the last
    level puts above their caps; the level only rises, so it ends."""
    cap, level, clamped = F.col("source_size") * most, 0.0, -1
    while True:
        above = (F.col("weight") * F.lit(level) > cap) if clamped >= 0 else F.lit(False)
        r = sources.agg(F.sum("source_size").alias("words"), F.sum(F.when(above, cap).otherwise(0)).alias("given"),
                        F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight"),
                        F.sum(above.cast("int")).alias("clamped")).first()
        if not r["weight"] or r["clamped"] == clamped:
            return level
        level, clamped = float(r["words"] - r["given"]) / float(r["weight"]), r["clamped"]


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS, seed: str = SEED) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` of every document, with its
    ``source``, the source's ``epochs`` and the document's whole ``repetitions``."""
    rows = docs.select(
        "doc_id", F.col("source").isNull().alias("no_source"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        word_count(text_or_empty()).alias("size"), F.unhex(sample_key(seed)).alias("key"), F.monotonically_increasing_id().alias("row"))
    rows = ranged(rows, [F.col(c) for c in (*_SOURCE, "key", "row")], "mix")

    cycle = F.array(*[F.lit(int(w)) for w in weights])
    sources = numbered_sources(rows)
    weight = F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int"))
    sources = write_scratch(sources.withColumn("weight", weight), "weights")
    level = water_level(sources, most)
    cap = (F.col("source_size") * most).cast("double")
    sources = sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))
    sources = sources.withColumn("epochs", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    sources = sources.withColumn("whole", F.floor("epochs"))
    # words of the fractional repetition
    more = F.round(F.col("target") - (F.col("whole") * F.col("source_size")).cast("double")).cast("long")
    sources = sources.withColumn("more", more)

    # a source's range is the words from source_start on; a document starts where those before it end
    order = Window.partitionBy("part").orderBy(*_SOURCE, "key", "row")
    shift = before_parts(rows, {"words_before": F.sum("size")})
    in_part = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    known = rows.select("part", *_SOURCE).distinct().join(sources, [*_SOURCE])
    rows = (rows.withColumn("start", in_part).join(F.broadcast(shift), "part")
            .withColumn("start", F.col("start") + F.col("words_before")))
    rows = rows.join(known, ["part", *_SOURCE])
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("more") - (F.col("start") - F.col("source_start"))))
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + extra).cast("long").alias("taken"),
        F.when(~F.col("no_source"), F.col("source")).alias("source"), "epochs", F.col("whole").alias("repetitions"))


def op12_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place
  FROM sized GROUP BY source),
weighted AS (SELECT *, place % 3 + 1 AS weight, {MOST_EPOCHS} * source_size AS cap FROM sources),
-- sources by the level that clamps them: the first level that clamps no further source holds
filled AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM weighted WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * coalesce((
    SELECT level FROM filled WHERE weight * level <= cap ORDER BY cap / weight, place LIMIT 1), 0)) AS target FROM filled),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS epochs FROM targets),
wholes AS (
  SELECT *, CAST(floor(epochs) AS BIGINT) AS whole,
         CAST(round(target - floor(epochs) * source_size) AS BIGINT) AS more FROM epochs),
placed AS (
  SELECT sized.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sized)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(whole * size + greatest(0, least(size, more - start)) AS BIGINT) AS taken,
       p.source, epochs, whole AS repetitions
FROM placed p JOIN wholes w ON p.source IS NOT DISTINCT FROM w.source
"""
