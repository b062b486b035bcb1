"""Whitening against exact fractions and a plain decomposition."""

import math
from fractions import Fraction

import numpy as np
import pytest

from arealens.llm import whitening
from arealens.llm.whitening import fit_whitening, whiten


def usable(rows):
    return [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]


def brute(rows):
    """(n, deviation per row, exact covariance) of the integer vectors."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in usable(rows)]
    n, d = len(x), len(x[0])
    s = [sum(r[a] for r in x) for a in range(d)]
    y = [[n * r[a] - s[a] for a in range(d)] for r in x]
    covariance = [[Fraction(sum(r[a] * r[b] for r in y), n**3) for b in range(d)] for a in range(d)]
    return n, s, [sum(c * c for c in r) for r in y], np.array([[float(c) for c in r] for r in covariance])


def sample(n, d, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, d)) * np.linspace(1, 3, d) @ rng.normal(size=(d, d))
    return [(i, [float(np.float32(c * spread)) for c in row]) for i, row in enumerate(mixed)]


def odd_rows(d):
    return [(900, None), (901, []), (902, [None] * d), (903, [float("nan")] + [0.0] * (d - 1)), (904, [float("inf")] * d), (905, [1.0] * (d + 1))]


@pytest.mark.parametrize("d, spread", [(5, 1.0), (40, 0.2), (3, 3e7)])
def test_values_equal_brute_force(spark, d, spread):
    rows = sample(200, d, d, spread)
    given = [*rows, *odd_rows(d), rows[3], (None, rows[4][1])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in given], "vec_id long, embedding array<double>, n int, component string").repartition(5)
    n, sums, deviations, covariance = brute([*rows, rows[3], rows[4]])
    fit = fit_whitening(df)
    assert (fit.n, list(fit.sums)) == (n, sums)
    again = (fit.vectors * fit.values) @ fit.vectors.T
    assert np.abs(again - covariance).max() <= 1e-12 * np.abs(covariance).max()
    got = whiten(df).collect()
    k = min(d, 32)
    assert len(got) == n * k and {r.n for r in got} == {n}
    by_row = {(r.vec_id, r.component): r for r in got}
    for i, (vec_id, v) in enumerate(rows):
        want = deviations[i] if deviations[i] < 2**63 else None
        assert by_row[vec_id, 1].deviation == want
        x = np.array([math.floor(64 * c) + 1_000_000 - Fraction(s, n) for c, s in zip(v, sums)], float)
        w = [by_row[vec_id, c + 1].whitened for c in range(k)]
        np.testing.assert_allclose(w, x @ fit.vectors[:, :k] / np.sqrt(fit.values[:k]), rtol=1e-8, atol=1e-10)
    w = np.array([r.whitened for r in sorted(got, key=lambda r: (r.component, str(r.vec_id)))]).reshape(k, n).T
    assert np.abs(np.cov(w.T, bias=True) - np.eye(k)).max() < 1e-9 + got[0].identity_error
    assert got[0].identity_error < 1e-6 and len({r.identity_error for r in got}) == 1
    np.testing.assert_allclose(by_row[0, 1].explained, np.linalg.eigvalsh(covariance)[-1] / np.trace(covariance), rtol=1e-9)


def test_large_entries_are_summed_exactly(monkeypatch):
    import pyarrow as pa

    z = [[2**38 / 64, 1.0], [-(2**38) / 64, 3.0]]
    monkeypatch.setattr(whitening, "_ROWS", 1)
    middle = np.array([whitening.SHIFT] * 2)
    total = {}
    for part in whitening._square_sums(middle)(pa.array(z)):
        for a, v in part.items():
            total[a] = total[a] + v if a in total else v
    assert total[0].tolist() == [2 * 2**76, (2**38 + 64) ** 2 + (192 - 2**38) ** 2]
    assert total[1].tolist() == [64**2 + 192**2]


def test_without_variance_or_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    one = whiten(spark.createDataFrame([(7, [1.0, 2.0])], schema)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    flat = whiten(spark.createDataFrame([(k, [float(k), 2.0]) for k in range(4)], schema)).collect()
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True)} and flat[0].identity_error < 1e-12
    assert whiten(spark.createDataFrame([(1, None)], schema)).collect() == []
    assert whiten(spark.createDataFrame([], schema)).collect() == []
