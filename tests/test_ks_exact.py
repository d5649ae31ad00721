"""Two-sample KS p-values against enumeration of all orders, and the series against an exact one-sample computation."""

import itertools
import math

import numpy as np
import pytest

from tidewatch.config import DriftConfig
from tidewatch.operators import drift as drf


def enumerated(n, m, d):
    """Share of all interleavings of n and m values whose statistic is d or more."""
    hits = total = 0
    for chosen in itertools.combinations(range(n + m), n):
        x = np.zeros(n + m)
        x[list(chosen)] = 1
        gap = np.abs(np.cumsum(x) / n - np.cumsum(1 - x) / m).max()
        hits, total = hits + (gap >= d - 1e-12), total + 1
    return hits / total


@pytest.mark.parametrize("n,m", [(1, 1), (1, 5), (2, 2), (3, 2), (3, 3), (4, 3), (5, 5), (6, 4), (7, 3), (2, 9), (8, 4), (6, 6), (5, 7), (9, 3), (4, 8), (10, 2), (7, 5), (8, 6), (3, 10), (6, 8)])
def test_exact_equals_enumeration(n, m):
    for d in sorted({abs(i / n - j / m) for i in range(n + 1) for j in range(m + 1)}):
        assert drf.ks_outside(n, m, d) == pytest.approx(enumerated(n, m, d), abs=1e-12)
        assert drf.ks_outside(m, n, d) == pytest.approx(drf.ks_outside(n, m, d), abs=1e-12)


def one_sample(n, d):
    """P(D_n >= d), exactly, by powers of a matrix of the banded walk."""
    k = int(n * d) + 1
    h, size = k - n * d, 2 * k - 1
    H = np.zeros((size, size))
    for i in range(size):
        for j in range(size):
            H[i, j] = 0 if i - j + 1 < 0 else 1
    for i in range(size):
        H[i, 0] -= h ** (i + 1)
        H[size - 1, i] -= h ** (size - i)
    H[size - 1, 0] += (2 * h - 1) ** size if 2 * h - 1 > 0 else 0
    for i in range(size):
        for j in range(size):
            if i - j + 1 > 0:
                H[i, j] /= math.factorial(i - j + 1)
    q = np.linalg.matrix_power(H, n)[k - 1, k - 1]
    for i in range(1, n + 1):
        q *= i / n
    return 1 - q


@pytest.mark.parametrize("n,d", [(100, 0.05), (100, 0.08), (100, 0.1), (140, 0.12), (100, 0.14), (140, 0.15)])
def test_series_equals_the_exact_one_sample_distribution(n, d):
    assert drf.ks_series(n, d) == pytest.approx(one_sample(n, d), abs=2e-5)


def test_series_is_a_distribution():
    p = [drf.ks_series(5000, d) for d in np.linspace(0, 0.2, 200)]
    assert p[0] == 1.0 and all(a >= b - 1e-9 for a, b in zip(p, p[1:], strict=False)) and p[-1] < 1e-12


def test_methods_agree_for_large_samples(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=4000).round(2), rng.normal(0.03, 1, size=3000).round(2)
    ref, cur = (spark.createDataFrame([(float(v),) for v in x], "f double") for x in (a, b))
    p = {m: drf.ks_drift(ref, cur, DriftConfig(features=("f",), p_method=m)).first().p_value for m in ("auto", "limiting")}
    series = drf.ks_drift(ref, cur, DriftConfig(features=("f",), p_exact_rows=10)).first().p_value
    assert p["auto"] == pytest.approx(p["limiting"], abs=0.02) and series == pytest.approx(p["auto"], abs=0.02)
