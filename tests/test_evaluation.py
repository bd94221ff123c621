"""AUC, calibration and segments against plain versions, with ties, nulls and pieces of any size."""

from __future__ import annotations

import collections
import random

import pytest
from pyspark.sql import functions as F

from countertide.operators import evaluation


def table(spark, rows):
    return spark.createDataFrame(rows, "y int, score double, g string")


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    out = [(int(r.random() < s), s + r.choice([0.0, 0.1]), r.choice("aab")) for s in (r.choice([k / 40 for k in range(41)]) for _ in range(600))]
    return [*out, (None, 0.5, "a"), (1, None, "a"), (0, float("nan"), "b"), (1, -0.0, "b"), (0, 0.0, "b")]


def known(rows):
    return [(y, s) for y, s, _ in rows if y is not None and s is not None and s == s]


def plain_auc(rows):
    good, bad = [s for y, s in rows if y == 1], [s for y, s in rows if y != 1]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) if good and bad else None


@pytest.mark.parametrize("slices", [1, 7])
def test_auc_counts_pairs(spark, rows, slices):
    got = evaluation.exact_auc(table(spark, rows), "y", "score", slices=slices).head()
    assert got.rows == len(known(rows)) and got.auc == pytest.approx(plain_auc(known(rows)), rel=1e-12)
    for r in evaluation.exact_auc(table(spark, rows), "y", "score", by=["g"], slices=slices).collect():
        assert r.auc == pytest.approx(plain_auc(known([x for x in rows if x[2] == r.g])), rel=1e-12)


def test_auc_without_both_classes(spark, rows):
    assert evaluation.exact_auc(table(spark, [(1, 0.2, "a")]), "y", "score").head().auc is None
    assert evaluation.exact_auc(table(spark, []), "y", "score", by=["g"]).count() == 0


def plain_isotonic(rows):
    """The largest of the smallest means."""
    at = collections.defaultdict(list)
    for y, s in rows:
        at[s].append(y == 1)
    scores = sorted(at)
    mean = {}
    for j in range(len(scores)):
        n = p = 0
        for k in range(j, len(scores)):
            n, p = n + len(at[scores[k]]), p + sum(at[scores[k]])
            mean[j, k] = p / n
    return {s: max(min(mean[j, k] for k in range(i, len(scores))) for j in range(i + 1)) for i, s in enumerate(scores)}


@pytest.mark.parametrize("pool_rows", [2, 3, 10, 1000])
def test_calibration_is_the_rising_fit(spark, rows, pool_rows):
    got = evaluation.isotonic_calibration(table(spark, rows), "y", "score", pool_rows).orderBy("low").collect()
    want = plain_isotonic(known(rows))
    for r in got:
        assert all(v == pytest.approx(r.calibrated) for s, v in want.items() if r.low <= s <= r.high)
    assert all(a.calibrated < b.calibrated and a.high < b.low for a, b in zip(got, got[1:]))
    assert sum(r.n for r in got) == len(known(rows)) and sum(r.positives for r in got) == sum(y == 1 for y, _ in known(rows))


def test_calibration_of_a_falling_score_is_one_block(spark):
    falling = table(spark, [(int(k < 20), float(k), "a") for k in range(40)])
    got = evaluation.isotonic_calibration(falling, "y", "score", 4).collect()
    assert [(r.low, r.high, r.n, r.calibrated) for r in got] == [(0.0, 39.0, 40, 0.5)]
    assert evaluation.isotonic_calibration(table(spark, []), "y", "score").count() == 0


def test_segments_are_means_over_their_rows(spark, rows):
    df = table(spark, rows).withColumn("loss", F.abs(F.col("y") - F.col("score")))
    got = evaluation.weak_segments(df, F.nanvl("loss", F.lit(None).cast("double")), ["score"], ["g"], parts=3, min_share=0.1).collect()
    borders = evaluation.segment_bins(df.filter("NOT isnan(score) OR score IS NULL"), ["score"], 3)["score"]
    assert {(r.feature_a, r.feature_b) for r in got} == {("score", None), ("g", None), ("score", "g")}
    total = [abs(y - s) for y, s in known(rows)]
    for r in got:
        if r.feature_a == "score" and r.feature_b == "g":
            inside = [abs(y - s) for y, s, g in rows if y is not None and s is not None and s == s and g == r.segment_b and str(sum(s > b for b in borders)) == r.segment_a]
            assert (r.n, r.loss) == (len(inside), pytest.approx(sum(inside) / len(inside)))
            assert r.excess == pytest.approx(r.loss - sum(total) / len(total)) and r.n >= 0.1 * len(total)
    assert [r.excess for r in got] == sorted((r.excess for r in got), reverse=True)
    assert evaluation.weak_segments(df.limit(0), F.col("loss"), ["score"], ["g"]).count() == 0
