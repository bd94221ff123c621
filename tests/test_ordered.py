"""Sliced order-dependent computations against brute force, with one key holding most rows."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from countertide.operators import stats
from countertide.plans.ordered import exact_quantile, mean_of_previous, running_totals
from countertide.plans.skew import hot_keys, join_spreading_hot_keys


def skewed(n: int, seed: int = 1) -> pd.DataFrame:
    rng = random.Random(seed)
    keys = [0 if rng.random() < 0.5 else rng.randrange(1, 40) for _ in range(n)]
    return pd.DataFrame({"k": keys, "o": rng.sample(range(10 * n), n), "v": [rng.randrange(100) for _ in range(n)]})


@pytest.mark.parametrize("slices", [1, 3, 16, 64])
def test_running_totals(spark, slices):
    pdf = skewed(600).sort_values(["k", "o"])
    pdf["want"] = pdf.groupby("k").v.cumsum()
    got = running_totals(spark.createDataFrame(pdf[["k", "o", "v"]]), ["k"], ["o"], ["v"], slices=slices).toPandas()
    merged = got.merge(pdf, on=["k", "o"])
    assert len(got) == len(pdf) and (merged.cum_v == merged.want).all()


def test_running_totals_with_null_keys_and_without_keys(spark):
    pdf = skewed(300)
    df = spark.createDataFrame(pdf).withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    got = running_totals(df, ["k"], ["o"], ["v"], slices=16).toPandas()
    want = df.toPandas().sort_values("o")
    want["want"] = want.groupby("k", dropna=False).v.cumsum()
    assert sorted(got.cum_v) == sorted(want.want)
    total = running_totals(df, [], ["o"], ["v"], slices=16).toPandas().sort_values("o")
    assert list(total.cum_v) == list(pdf.sort_values("o").v.cumsum())


@pytest.mark.parametrize("n, slices", [(1, 16), (2, 5), (5, 16), (5, 100), (50, 16)])
def test_mean_of_previous(spark, n, slices):
    # More slices than rows per key: a frame can reach over many slices.
    pdf = skewed(400).sort_values(["k", "o"])
    pdf["want"] = pdf.groupby("k").v.transform(lambda s: s.rolling(n, min_periods=1).mean().shift(1))
    got = mean_of_previous(spark.createDataFrame(pdf[["k", "o", "v"]]), ["k"], ["o"], "v", n, "m", slices=slices).toPandas()
    merged = got.merge(pdf, on=["k", "o"])
    assert len(got) == len(pdf)
    assert np.allclose(merged.m.fillna(-1), merged.want.fillna(-1))


@pytest.mark.parametrize("q", [0.0, 0.01, 0.5, 0.8, 0.9, 1.0])
def test_exact_quantile(spark, q):
    values = skewed(501).v.astype(float).tolist() + [7.0] * 400
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    assert exact_quantile(df, "v", q).first()[0] == pytest.approx(np.quantile(values, q))


def test_quantile_of_ten_values(spark):
    df = spark.createDataFrame([(v,) for v in range(10, 101, 10)], "views long")
    assert exact_quantile(df, "views", 0.9).first()[0] == pytest.approx(91)


def test_quantile_of_nothing_is_null(spark):
    assert exact_quantile(spark.createDataFrame([], "v double"), "v", 0.5).first()[0] is None


def test_ks_statistic(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(0, 1, 700).round(1), rng.normal(0.3, 1.2, 400).round(1)
    rows = [("x", float(v), False) for v in a] + [("x", float(v), True) for v in b]
    rows += [("y", float(v), i % 2 == 0) for i, v in enumerate(a)]
    got = {r.feature: r for r in stats.ks_two_sample(spark.createDataFrame(rows, "feature string, value double, current boolean"), slices=16).collect()}
    grid = np.union1d(a, b)
    share = lambda s: np.searchsorted(np.sort(s), grid, side="right") / len(s)
    assert got["x"].ks_statistic == pytest.approx(np.abs(share(a) - share(b)).max())
    assert got["x"].p_value < 0.01 < got["y"].p_value <= 1
    verdicts = {r.feature: r.verdict for r in stats.drift_verdict(spark.createDataFrame(list(got.values()))).collect()}
    assert verdicts["x"] == "drift" and verdicts["y"] == "stable"


def test_ks_is_symmetric_and_zero_for_equal_samples(spark):
    rows = [("x", float(i % 5), c) for i in range(50) for c in (True, False)]
    got = stats.ks_two_sample(spark.createDataFrame(rows, "feature string, value double, current boolean")).first()
    assert got.ks_statistic == 0 and got.p_value == 1


def test_hot_keys_are_few_and_joined_whole(spark):
    pdf = skewed(2000)
    fact = spark.createDataFrame(pdf)
    hot = [r.k for r in hot_keys(fact, "k", limit=10).collect()]
    assert 0 in hot and len(hot) <= 10
    dim = spark.createDataFrame([(k, f"name{k}") for k in range(30)], "k long, name string")
    got = join_spreading_hot_keys(fact, dim, "k", spread_on="o", limit=10, salts=8)
    want = pdf.merge(dim.toPandas(), on="k")
    assert sorted(map(tuple, got.select("k", "o", "v", "name").toPandas().values)) == sorted(map(tuple, want[["k", "o", "v", "name"]].values))
