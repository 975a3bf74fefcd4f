"""Embedding whitening by Chebyshev-filtered subspace iteration (operator 11).

Vectors are made whole numbers, x = floor(256 c).  The fit list is every
distinct x once; V is its covariance (divisor n).  The leading eigenvectors of
V are found without forming V: a block Q of a few columns is multiplied by V in
distributed passes, V Q = sum of (x - S/n) (x - S/n)^T Q over the fit list / n,
each task adding up its own part.  One round is

1. a polynomial of degree DEGREE in V on Q by the Chebyshev three-term
   recurrence, scaled so that the unwanted spectrum, from 0 to the least Ritz
   value of the block, is damped to [-1, 1] while what lies above it grows
   exponentially with the degree,
2. QR of the filtered block,
3. Rayleigh-Ritz on it, and the residuals |V u - e u| of the wanted pairs.

It ends when every wanted residual is at most TOLERANCE times the largest
eigenvalue (certified), or when rounding stops the residuals from falling and
they are below LOOSE times it.  The driver holds blocks of dimension x columns
and one sum row for each entry of a block, whatever the number of vectors.

Edge cases: rows whose vector is null, holds null or non-finite entries, or is
not of the most common length (of equally common lengths, the longest) are
dropped; equal vectors are fitted once and all returned; components without
variance (fewer than four distinct vectors, constant entries) are not returned;
an empty table gives an empty result; other columns are not read.  ``deviation``
is a 64-bit sum: a vector that would overflow it is an error, not a wrong value.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, write_scratch
from .textarrays import lean

#: Components; more columns of the block; degree of the filter; seed of the first block.
COMPONENTS, GUARD_COLUMNS, DEGREE, SEED = 4, 8, 12, 29
#: Residual, as a part of the largest eigenvalue, at which a pair is certified, and the
#: most that is accepted once rounding stops it from falling; most rounds.
TOLERANCE, LOOSE, ROUNDS = 1e-13, 1e-9, 200
#: Factor of the whole numbers; vectors that a task works on at once.
SCALE, BLOCK_ROWS = 256, 4096


def whole_numbers(vector: str) -> Column:
    """The entries as whole numbers."""
    return F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """The rows with a whole, finite vector of the common length."""
    bad = F.exists(F.col(vector), lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == math.inf))
    rows = rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)))
    sizes = rows.groupBy(F.size(vector).alias("length")).agg(F.count("*").alias("n"))  # one row per length
    common = sizes.agg(F.max(F.struct("n", "length"))["length"].alias("length")).first()["length"]
    return rows.filter(F.size(vector) == F.lit(common))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def column_sums(fit: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over the fit list of ``part(block of x vectors)``, an array of one
    shape; every task sends one array, and Spark adds them entry by entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                found = part(_matrix(batch.column("x").slice(at, BLOCK_ROWS)))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()])], ["sums"])

    sums = fit.mapInArrow(lean(run), f"sums array<{kind}>").select(F.posexplode("sums").alias("place", "value"))
    rows = sums.groupBy("place").agg(F.sum("value").alias("value")).collect()  # as many rows as the array has entries
    return np.array([r["value"] for r in sorted(rows, key=lambda r: r["place"])])


@dataclass
class Whitening:
    """``n`` and ``sums`` of the fit list; unit eigenvectors (columns), their
    eigenvalues, the trace of V, the certificate (largest residual as a part of
    the largest eigenvalue) and the largest error of the whitened covariance."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    identity_error: float

    def of(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.sums / self.n) @ self.vectors) / np.sqrt(self.values)


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, width: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` leading eigenpairs of a symmetric positive semidefinite matrix
    of ``size`` rows, known by its ``product`` with a block, and the certificate."""
    width = min(size, width)
    q = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, width)))[0]
    best, stalled = np.inf, 0
    for _ in range(ROUNDS):
        vq = product(q)
        h = q.T @ vq
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        u, vu = q @ turn, vq @ turn
        top = max(values[0], 0.0)
        if top == 0 or width == size:  # nothing varies, or the block is the whole space
            return u[:, :wanted], values[:wanted], 0.0
        residual = float(np.max(np.linalg.norm(vu - u * values, axis=0)[:wanted])) / top
        stalled = stalled + 1 if residual > best / 2 else 0
        best = min(best, residual)
        if residual <= TOLERANCE or (stalled >= 3 and residual <= LOOSE):
            return u[:, :wanted], values[:wanted], residual
        # [0, cut] goes to [-1, 1]; scaled by its value at the largest Ritz value, so nothing overflows
        half = max(values[-1], top * 1e-12) / 2
        scale = half / (top - half)
        ratio, before, now = 2 / scale, u, (vu - half * u) * (scale / half)
        for _ in range(2, DEGREE + 1):
            after = 1 / (ratio - scale)
            before, now = now, (product(now) - half * now) * (2 * after / half) - scale * after * before
            scale = after
        q = np.linalg.qr(now)[0]
    raise ArithmeticError(f"no certified eigenvectors after {ROUNDS} rounds: residual {residual}")


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a fit list (column ``x``); None when it is empty."""
    counted = column_sums(fit, lambda x: np.append(x.sum(axis=0), len(x)), "long")
    if not len(counted):
        return None
    n, sums = int(counted[-1]), counted[:-1].astype(np.int64)
    mean, size = sums / n, len(sums)
    trace = float(column_sums(fit, lambda x: np.array([np.square(x - mean).sum()]), "double")[0]) / n

    def product(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ block)
        return column_sums(fit, part, "double").reshape(block.shape) / n

    vectors, values, residual = leading_pairs(product, size, components, components + GUARD_COLUMNS)
    some = values > 1e-12 * max(trace, 1e-300)
    vectors, values = vectors[:, some], values[some]
    if not len(values):
        return Whitening(n, sums, vectors, values, trace, residual, 0.0)

    def outer(x: np.ndarray) -> np.ndarray:
        y = ((x - mean) @ vectors) / np.sqrt(values)
        return y.T @ y

    error = column_sums(fit, outer, "double").reshape(len(values), -1) / n - np.eye(len(values))
    return Whitening(n, sums, vectors, values, trace, residual, float(np.abs(error).max()))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Sum over the entries of (n x - S)^2, exact."""
    most = max((abs(n * int(lo) - int(s)), abs(n * int(hi) - int(s))) for lo, hi, s in zip(x.min(axis=0), x.max(axis=0), sums, strict=True))
    if max(most) ** 2 * x.shape[1] >= 1 << 63:  # near the limit: whole numbers of any size
        found = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
        if max(found) >= 1 << 63:
            raise OverflowError("a deviation does not fit into 64 bits")
        return np.array(found, np.int64)
    return np.square(n * x - sums).sum(axis=1)


def whiten(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``
    and ``identity_error`` for every usable row and component."""
    kind = rows.schema[id_column].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    kept = usable(rows.select(F.col(id_column).alias("vec_id"), F.col(vector).alias("vector")), "vector")
    kept = kept.select("vec_id", whole_numbers("vector").alias("x"))
    # copies meet as one row of each task before anything moves
    held = fit_whitening(write_scratch(kept.select("x").distinct(), "fit-list"), components)
    if held is None:
        return rows.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(held.values)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                x = _matrix(batch.column("x"))
                index = np.repeat(np.arange(len(x)), k)
                size = len(index)
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").take(pa.array(index)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, held.n)), pa.array(deviations(x, held.n, held.sums)[index]), pa.array(held.of(x).ravel()),
                    pa.array(np.tile(held.values / held.trace, len(x))), pa.array(np.full(size, held.identity_error)),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return kept.mapInArrow(lean(run), schema)


def op11_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
