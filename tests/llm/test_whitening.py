"""Whitening against a plain eigendecomposition, and the contour against hard spectra."""

from __future__ import annotations

import math

import numpy as np
import pytest

from skyledger.llm import contour, whitening

DATA = "/root/testdata/sf0.001"


def spectrum_matrix(values, seed=1):
    basis, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    matrix = (basis * values) @ basis.T
    return (matrix + matrix.T) / 2


SPECTRA = {
    "falling": 1000 * 0.7 ** np.arange(40.0),
    "flat": np.ones(24),
    "clustered": np.concatenate([np.full(10, 5.0), np.full(12, 5 - 1e-9), np.full(20, 1.0)]),
    "one": np.array([3.0]),
    "two": np.array([3.0, 1.0]),
    "low rank": np.concatenate([[9.0, 4.0, 1.0], np.zeros(30)]),
    "wide": np.concatenate([[1e8, 1e3, 1.0], np.linspace(0.1, 0.5, 60)]),
    "even": np.linspace(1, 2, 64),
    "zero": np.zeros(5),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_leading_components(name):
    matrix = spectrum_matrix(SPECTRA[name])
    values, vectors = contour.leading(matrix, 16)
    expected = np.sort(SPECTRA[name])[::-1]
    expected = expected[expected > max(expected.sum(), 1e-300) * 1e-13][:16]
    scale = max(expected.max(initial=0), 1e-300)
    assert len(values) == len(expected)
    assert np.allclose(values, expected, rtol=0, atol=1e-12 * scale)
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-12)
    assert np.abs(vectors @ matrix - values[:, None] * vectors).max(initial=0) <= 1e-12 * scale


def test_inertia():
    values = np.linspace(-3, 3, 31)
    inertia = contour.Inertia(spectrum_matrix(values))
    for shift in (-4, -1.05, 0.07, 2.95, 4):
        assert inertia.above(shift) == (values > shift).sum()


def plain(rows, components=16):
    """Rows of (vec_id, vector) to {vec_id: (n, deviation, whitened, explained)}, identity error."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in good], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    order = order[values[order] > 1e-9]
    white = (x - sums / n) @ vectors[:, order] / np.sqrt(values[order])
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    explained = values[order] / np.trace(covariance)
    return [(i, n, int(d), w) for (i, _), d, w in zip(good, deviation, white, strict=True)], explained


def check(result, rows):
    expected, explained = plain(rows)
    found = {}
    for r in result:
        found.setdefault(r.vec_id, {})[r.component] = r
    assert len(result) == len(expected) * len(explained)
    for vec_id, n, deviation, white in expected:
        of_id = found[vec_id]
        assert sorted(of_id) == list(range(1, len(explained) + 1))
        for k, r in of_id.items():
            assert (r.n, r.deviation) == (n, deviation)
            assert abs(abs(r.whitened) - abs(white[k - 1])) < 1e-8
            assert abs(r.explained - explained[k - 1]) <= 1e-8 * explained[k - 1]
            assert r.identity_error <= 1e-8
    # one sign per component
    signs = [{np.sign(found[i][k + 1].whitened * w[k]) for i, *_, w in expected if abs(w[k]) > 1e-6}
             for k in range(len(explained))]
    assert all(len(s) == 1 for s in signs)


def test_sample_vectors(spark):
    vectors = spark.read.parquet(f"{DATA}/embeddings.parquet")
    check(whitening.whiten(vectors).collect(), [(r.vec_id, r.embedding) for r in vectors.collect()])


SCHEMA = "vec_id long, embedding array<float>, n int, x string, dim int, component int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows], SCHEMA).repartition(3)


def test_odd_vectors(spark):
    r = np.random.default_rng(4)
    some = [[float(c) for c in v] for v in r.normal(size=(30, 5)).astype(np.float32)]
    rows = list(enumerate(some))
    rows += [(100 + i, some[3]) for i in range(60)]  # most rows are one vector
    bad = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0]), (202, [math.nan] * 5), (203, [math.inf] * 5)]
    rows += [(204, [0.0] * 5)]
    check(whitening.whiten(frame(spark, rows + bad + [(205, [])])).collect(), rows)


def test_lengths_are_apart(spark):
    r = np.random.default_rng(5)
    short = [(i, [float(c) for c in v]) for i, v in enumerate(r.normal(size=(9, 2)).astype(np.float32))]
    long = [(50 + i, [float(c) for c in v]) for i, v in enumerate(r.normal(size=(40, 20)).astype(np.float32))]
    result = whitening.whiten(frame(spark, short + long)).collect()
    check([x for x in result if x.vec_id < 50], short)
    check([x for x in result if x.vec_id >= 50], long)


def test_nothing_to_whiten(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []


def test_null_ids_and_large_entries(spark):
    rows = [(None, [1e30, 0.0]), (None, [-1e30, 1.0]), (3, [0.0, 2.0])]
    result = whitening.whiten(frame(spark, rows)).collect()
    # the second eigenvalue is nought beside the first
    assert len(result) == 3 and sum(r.vec_id is None for r in result) == 2
    assert all(math.isfinite(r.whitened) for r in result)
    # the exact sum of squares is beyond a long
    assert all(r.deviation is None for r in result if r.vec_id is None)


def test_deviations_are_exact():
    r = np.random.default_rng(6)
    x = r.integers(10**6, 10**6 + 4000, (200, 3))
    centre = whitening.Centre(10**5, [int(s) for s in r.integers(10**11, 2 * 10**11, 3)])
    expected = [sum((10**5 * int(v) - s) ** 2 for v, s in zip(row, centre.sums)) for row in x]
    assert centre.deviations(x) == [e if e < 2**63 else None for e in expected]
