"""Exact p of the two-sample test against enumeration and the closed form of equal sizes."""

from __future__ import annotations

import itertools
import math
import time

import numpy as np
import pytest

from countertide.operators.exact_ks import ks_exact, touch_probability


def enumerated(n, m, gap):
    hits = 0
    for steps in itertools.combinations(range(n + m), n):
        i = j = 0
        chosen = set(steps)
        for t in range(n + m):
            i, j = (i + 1, j) if t in chosen else (i, j + 1)
            if abs(i * m - j * n) >= gap:
                hits += 1
                break
    return hits / math.comb(n + m, n)


@pytest.mark.parametrize("n", range(1, 9))
def test_equals_enumeration(n):
    for m in range(1, 9):
        if math.comb(n + m, n) > 4000:
            continue
        for gap in range(0, n * m + 2, max(1, n * m // 7)):
            want = 1.0 if gap == 0 else enumerated(n, m, gap)
            assert touch_probability(n, m, gap) == pytest.approx(want, rel=1e-12, abs=1e-300), (n, m, gap)


@pytest.mark.parametrize("n, h", [(50, 8), (50, 30), (400, 100), (2000, 150)])
def test_equals_reflection_for_equal_sizes(n, h):
    """2 sum over k of (-1)^(k+1) C(2n, n - kh) / C(2n, n)."""
    want = 2 * sum((-1) ** (k + 1) * math.comb(2 * n, n - k * h) for k in range(1, n // h + 1)) / math.comb(2 * n, n)
    assert touch_probability(n, n, h * n) == pytest.approx(want, rel=1e-9)


def test_small_values_keep_their_digits():
    # Both samples apart: only two of all paths.
    assert touch_probability(30, 20, 600) == pytest.approx(2 / math.comb(50, 20), rel=1e-12)


def test_largest_exact_sizes_end_soon():
    began = time.time()
    assert 0 < touch_probability(10_000, 9_999, 9_999 * 200) < 1
    assert time.time() - began < 20


def test_operator_sizes_methods_and_missing_sides(spark):
    r = np.random.default_rng(3)
    rows = [("a", float(v), bool(k % 3 == 0)) for k, v in enumerate(r.integers(0, 9, 40))]
    rows += [("same", 1.0, k == 0) for k in range(5)] + [("one side", 1.0, True)] + [("nan", float(k), k % 2 == 0) for k in range(60)]
    df = spark.createDataFrame(rows, "feature string, value double, current boolean")
    got = {x.feature: x for x in ks_exact(df, exact_up_to=29).collect()}
    assert set(got) == {"a", "same", "nan"}
    a = [(v, c) for f, v, c in rows if f == "a"]
    x, y = [v for v, c in a if not c], [v for v, c in a if c]
    gap = max(abs(sum(u <= v for u in x) * len(y) - sum(u <= v for u in y) * len(x)) for v, _ in a)
    assert got["a"].method == "exact" and got["a"].ks_statistic == pytest.approx(gap / len(x) / len(y))
    assert got["a"].p_value == touch_probability(len(x), len(y), gap)
    assert got["same"].p_value == 1.0 and got["same"].ks_statistic == 0.0
    assert got["nan"].method == "asymptotic"
    assert ks_exact(df.limit(0)).count() == 0
