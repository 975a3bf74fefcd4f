"""Embedding whitening against a dense eigendecomposition."""

import math

import numpy as np
import pytest

from touchline.llm import whitening

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, x string"


def dense(vectors):
    """n, S, eigenvalues, eigenvectors of the distinct whole-number vectors."""
    x = np.floor(256 * np.array(vectors, np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, values[::-1], turn[:, ::-1]


def check(rows, vectors, components=4):
    """``vectors`` by id; whitened values up to one sign for each component."""
    ids = list(vectors)
    x, n, sums, values, turn = dense([vectors[i] for i in ids])
    held = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == len(held) == components * len(ids)
    for c in range(components):
        want = (x - sums / n) @ turn[:, c] / math.sqrt(values[c])
        got = np.array([held[i, c + 1]["whitened"] for i in ids])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-7
        assert all(held[i, c + 1]["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-9) for i in ids)
    for i, row in zip(ids, x.tolist(), strict=True):
        assert {held[i, c]["deviation"] for c in range(1, components + 1)} == {sum((n * a - int(s)) ** 2 for a, s in zip(row, sums, strict=True))}
    assert all(r["n"] == n and 0 <= r["identity_error"] < 1e-9 for r in rows)


def test_whitening_equals_dense(spark):
    rows = whitening.op11_chebyshev_whitening(spark, SMALL).collect()
    given = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    usable = {r["vec_id"]: r["embedding"] for r in given
              if r["embedding"] is not None and all(c is not None and math.isfinite(c) for c in r["embedding"])}
    check(rows, usable)


@pytest.mark.parametrize("spectrum", [np.arange(30, 0, -1.0), np.array([9.0] * 3 + [8.9] * 9 + [1.0] * 18), 0.7 ** np.arange(30)])
def test_filter_finds_leading_pairs(spectrum):
    """Spectra with close, repeated and quickly falling values."""
    rng = np.random.default_rng(3)
    basis = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    matrix = basis @ np.diag(spectrum) @ basis.T
    vectors, values, residual = whitening.leading_pairs(lambda q: matrix @ q, 30, 4, 12)
    assert values == pytest.approx(np.sort(spectrum)[::-1][:4], rel=1e-10) and residual < 1e-9
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-9 * spectrum.max()
    assert np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-12


def test_whitening_edges(spark):
    rng = np.random.default_rng(8)
    scale = np.array([40, 20, 10, 5, 2, 1], float)
    good = {i: (rng.standard_normal(6) * scale).astype(np.float32).tolist() for i in range(60)}
    good[100] = good[7]  # an equal vector under another id counts once in the fit
    bad = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [math.nan] + [0.0] * 5), (203, [math.inf] + [0.0] * 5),
           (204, [1.0, 2.0]), (205, [])]
    given = spark.createDataFrame([(i, v, 0, "a") for i, v in [*good.items(), *bad]] + [(5, good[5], 1, None)], SCHEMA).repartition(4)
    rows = whitening.whiten(given).collect()
    twice = [r for r in rows if r["vec_id"] == 5]
    assert len(twice) == 8 and len({str(r) for r in twice}) == 4  # a repeated row is returned each time
    check([r for r in rows if r["vec_id"] != 5] + list({r["component"]: r for r in twice}.values()), good)
    assert whitening.whiten(given.limit(0)).count() == 0
    assert whitening.whiten(given.filter("vec_id >= 200 and vec_id < 204")).count() == 0


def test_fewer_components_than_four(spark):
    """Vectors on a line have one component; equal vectors have none."""
    line = {i: [float(i), 2.0 * i, 1.0] for i in range(10)}
    given = spark.createDataFrame([(i, v, 0, "a") for i, v in line.items()], SCHEMA)
    check(whitening.whiten(given).collect(), line, components=1)
    assert whitening.whiten(given.selectExpr("vec_id", "array(1f, 2f, 3f) as embedding")).count() == 0


def test_deviation_limits():
    x = np.array([[3, -4], [1 << 20, 7]], np.int64)
    sums = x.sum(axis=0)
    assert whitening.deviations(x, 2, sums).tolist() == [sum((2 * int(a) - int(s)) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    near = np.array([[2_000_000_000, 0]], np.int64)
    assert whitening.deviations(near, 1, np.array([0, 0])).tolist() == [4 * 10**18]
    with pytest.raises(OverflowError):
        whitening.deviations(near, 2, np.array([0, 0]))
