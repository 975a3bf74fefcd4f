"""Bounded-frame windows that never put a whole group into one task.

``Window.partitionBy(team)`` sends every row of a team to one task.  Frames
here only look back a bounded number of rows (``ROWS k PRECEDING`` and
``lag(n)``), so the rows can be cut into consecutive buckets and each bucket
computed on its own, as long as it also sees the ``lookback`` rows of its
first group just before it (the *halo*).

There is one path at every size:

1. ``range_rows`` takes a random sample of the keys (group, order columns) and
   cuts it into even parts: the bounds, one key per bucket, are the only thing
   that is kept.  A row's bucket is an expression, the number of bounds at or
   below its key (a binary search), so every use of the rows sees the same
   buckets, also after a recomputation, and nothing is written.  A group that
   holds a third of all rows, or has them at one instant, is cut like any
   other; only rows equal in the whole key stay together.
2. ``bounded_window_frame`` runs the windows per (bucket, group) over the rows
   and the halo, then drops the halo: one exchange of all rows.

A bucket's lower bound names the group that goes on in it.  Its halo lies at
the ends of the buckets before it, so the last ``lookback`` rows of each bucket
are enough (a partial ``WindowGroupLimit`` cuts them before they move): at most
``lookback`` rows a bucket, however many groups there are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

StageFn = Callable[[WindowSpec, WindowSpec], list[Column]]

BUCKET, TIE = "__bucket", "__tie"
_HALO, _BOUNDS = "__halo", "__bounds"
#: Sampled keys for each bucket; seed of the sample.
SAMPLE_PER_BUCKET, SEED = 64, 7


@dataclass
class RangedRows:
    """Rows with the column ``BUCKET``, and the lowest key of every bucket but the first."""

    rows: DataFrame
    keys: tuple[str, ...]
    bounds: list[Row]

    def where(self, condition: Column) -> RangedRows:
        return RangedRows(self.rows.filter(condition), self.keys, self.bounds)

    def bounds_table(self) -> DataFrame:
        """``BUCKET`` and key of every bound: one row per bucket."""
        schema = self.rows.schema
        rows = _literals(schema, (BUCKET, *self.keys), [(i + 1, *b) for i, b in enumerate(self.bounds)])
        return self.rows.sparkSession.range(1, numPartitions=1).select(F.inline(rows))


def _literals(schema: StructType, columns: Sequence[str], rows: Sequence[Sequence]) -> Column:
    """``rows`` as one array of structs, with the types of these columns (and NULLs allowed)."""
    kind = StructType([StructField(c, schema[c].dataType) for c in columns])
    return F.array(*[F.struct(*[F.lit(v) for v in row]) for row in rows]).cast(ArrayType(kind))


def sample_bounds(df: DataFrame, keys: Sequence[str], buckets: int) -> list[Row]:
    """Keys that cut ``df`` into ``buckets`` parts of about the same number of rows:
    every SAMPLE_PER_BUCKET-th of a sorted random sample.  The driver gets one
    key per bucket."""
    sample = df.select(*keys).orderBy(F.rand(SEED)).limit(SAMPLE_PER_BUCKET * buckets)
    order = [F.col(c).asc_nulls_first() for c in keys]
    ranked = sample.select(*keys, F.row_number().over(Window.orderBy(*order)).alias("__n"),
                           F.count(F.lit(1)).over(Window.partitionBy()).alias("__of"))

    def part(n: Column) -> Column:
        return F.floor(n * buckets / F.col("__of"))

    firsts = ranked.filter((F.col("__n") > 1) & (part(F.col("__n") - 1) > part(F.col("__n") - 2)))
    found = [r[:-1] for r in sorted(firsts.select(*keys, "__n").collect(), key=lambda r: r["__n"])]  # one row per bucket
    return [Row(**dict(zip(keys, key, strict=True))) for i, key in enumerate(found) if i == 0 or key != found[i - 1]]


def bucket_of(df: DataFrame, keys: Sequence[str], bounds: Sequence[Row]) -> Column:
    """How many of the sorted ``bounds`` are at or below a row's key (NULLs first), as
    one expression; ``with_buckets`` is faster."""
    if not bounds:
        return F.lit(0)
    def key(values):
        return F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(keys, values, strict=True)])
    held, own = F.array(*[key(b) for b in bounds]), F.struct(*[F.col(c).alias(c) for c in keys])

    def halve(span: Column, _: Column) -> Column:
        """One step of the search: bounds below ``lo`` are at or below the key, from ``hi`` on above it."""
        middle = F.floor((span["lo"] + span["hi"]) / 2).cast("int")
        below = F.get(held, middle) <= own
        ended = span["lo"] >= span["hi"]
        return F.struct(F.when(~ended & below, middle + 1).otherwise(span["lo"]).alias("lo"),
                        F.when(ended | below, span["hi"]).otherwise(middle).alias("hi"))

    steps = F.array(*[F.lit(i) for i in range(len(bounds).bit_length())])
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.aggregate(steps, start, halve)["lo"]


def with_buckets(df: DataFrame, keys: Sequence[str], bounds: Sequence[Row]) -> DataFrame:
    """``df`` with the column ``BUCKET``: how many of the sorted ``bounds`` are at or
    below a row's key (NULLs first).  A binary search whose steps are columns of
    their own, so that Spark compiles them: the step of size s goes on by s when
    the bound there is at or below the key (beyond the last bound it is NULL)."""
    if not bounds:
        return df.withColumn(BUCKET, F.lit(0))
    # one type on both sides, or each step casts
    held = _literals(df.schema, keys, bounds)
    own = F.struct(*[F.col(c).alias(c) for c in keys]).cast(StructType([StructField(c, df.schema[c].dataType) for c in keys]))
    at = F.lit(0)
    out = df.withColumn(_BOUNDS, held)
    for b in reversed(range(len(bounds).bit_length())):
        step = 1 << b
        out = out.withColumn(BUCKET, at + F.when(F.get(_BOUNDS, at + (step - 1)) <= own, step).otherwise(0))
        at = F.col(BUCKET)
    return out.drop(_BOUNDS)


def range_rows(df: DataFrame, partition: Sequence[str], order: Sequence[str],
               buckets: int | None = None, bounds: Sequence[Row] | None = None) -> RangedRows:
    """``df`` cut into ``buckets`` even consecutive ranges of (partition, order), or
    into those of given ``bounds``.  ``buckets`` is ``spark.sql.shuffle.partitions``
    unless given; size it by the data (about 200 MB a bucket)."""
    keys = (*partition, *order)
    if bounds is None:
        bounds = sample_bounds(df, keys, buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return RangedRows(with_buckets(df, keys, bounds), keys, list(bounds))


def _with_tie(df: DataFrame) -> DataFrame:
    """Rows equal in the key are ordered by their other columns, the same in every range."""
    return df.withColumn(TIE, F.xxhash64(*[F.col(c) for c in df.columns if c not in (BUCKET, _HALO)]))


def halo_rows(ranged: RangedRows, partition: Sequence[str], lookback: int) -> DataFrame:
    """For the group that goes on in each bucket, its ``lookback`` rows before the bucket."""
    rows = _with_tie(ranged.rows)
    backwards = Window.partitionBy(BUCKET).orderBy(*[F.col(c).desc_nulls_last() for c in (*ranged.keys, TIE)])
    tails = (rows.withColumn("__n", F.row_number().over(backwards)).filter(F.col("__n") <= lookback)
             .select(*ranged.keys, TIE, F.struct(*ranged.rows.columns).alias("__row")))
    heads = ranged.bounds_table().select(F.col(BUCKET).alias("__to"), *ranged.keys)
    # a head stands before the rows of its own key, which are in its bucket
    before = (Window.partitionBy(*partition).orderBy(*[F.col(c).asc_nulls_first() for c in (*ranged.keys, TIE)])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edges = (tails.unionByName(heads, allowMissingColumns=True)
             .withColumn("__seen", F.count("__row").over(before).cast("int")))
    # a group's edges, at most (lookback + 1) for each bucket, in one row: read once, not joined
    groups = edges.groupBy(*partition).agg(
        F.array_sort(F.collect_list(F.when(F.col("__row").isNotNull(), F.struct("__seen", "__row")))).alias("tails"),
        F.collect_list(F.when(F.col("__to").isNotNull(), F.struct("__seen", "__to"))).alias("heads"))

    def last_tails(head: Column) -> Column:
        first = F.greatest(F.lit(1), head["__seen"] - lookback + 1)
        rows = F.slice("tails", first, F.least(F.lit(lookback), head["__seen"]))
        return F.transform(rows, lambda tail: F.struct(tail["__row"].alias("__row"), head["__to"].alias("__to")))

    return (groups.select(F.explode(F.flatten(F.transform("heads", last_tails))).alias("__r"))
            .select("__r.__row.*", F.col("__r.__to").alias("__to")).withColumn(BUCKET, F.col("__to")).drop("__to"))


def bounded_window_frame(ranged: RangedRows, partition: Sequence[str], order: Sequence[str],
                         preceding: int, stages: Sequence[StageFn], lookback: int, keep_buckets: bool = False) -> DataFrame:
    """Apply window ``stages`` over ``partition`` ordered by ``order`` (ascending,
    NULLs first), where no stage looks back more than ``lookback`` rows.
    ``ranged`` is a result of ``range_rows`` over the same columns, or a part of
    one.  ``keep_buckets`` leaves ``BUCKET`` in the result, whose partitions then
    hold whole buckets, each sorted by key."""
    out = ranged.rows.withColumn(_HALO, F.lit(False))
    if ranged.bounds:
        out = out.unionByName(halo_rows(ranged, partition, lookback).withColumn(_HALO, F.lit(True)))
    out = _with_tie(out)
    if keep_buckets:
        out = out.repartition(F.col(BUCKET))
    w_order = (Window.partitionBy(BUCKET, *partition)
               .orderBy(*(F.col(c).asc_nulls_first() for c in order), F.col(TIE).asc()))
    w_rows = w_order.rowsBetween(-preceding, Window.currentRow)
    for stage in stages:
        out = out.select("*", *stage(w_rows, w_order))
    out = out.filter(~F.col(_HALO)).drop(TIE, _HALO)
    return out if keep_buckets else out.drop(BUCKET)
