"""Distributions: counts, histograms, correlations, trends and drift tests."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countertide.functions.numeric import pearson
from countertide.plans.ordered import range_slices, running_totals_of_slices

# When a difference counts as drift, and the terms of the asymptotic series.
DRIFT_P = 0.05
DRIFT_D = 0.1
SERIES_TERMS = 100
DRIFT_FEATURES = ("views", "likes", "comments", "duration_seconds")
LOG_FEATURES = ("views", "likes", "comments")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are not counted."""
    counted = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), col)


def _bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Index of the equal-width bin; the last bin includes its upper edge."""
    place = F.floor((value - low) * bins / F.when(high > low, high - low).otherwise(1.0)).cast("int")
    return F.least(F.greatest(place, F.lit(0)), F.lit(bins - 1))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Counts in ``bins`` equal bins between the extremes, empty bins included."""
    values = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    ends = values.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    placed = values.select(_bin_of(F.col("v"), low, high, bins).alias("bin"))
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    edges = ends.select("low", ((F.col("high") - F.col("low")) / bins).alias("width")).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "low", "width"
    )
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def drift_rows(
    df: DataFrame, asof: dt.datetime, cut_hours: float = 24, time: str = "time", features: Sequence[str] = DRIFT_FEATURES
) -> DataFrame:
    """Long form (feature, value, current) of both samples from a single scan; counters on a log scale."""
    cut = F.lit(asof - dt.timedelta(hours=cut_hours))
    cells = [
        F.struct(
            F.lit(f).alias("feature"),
            (F.log1p(F.col(f).cast("double")) if f in LOG_FEATURES else F.col(f).cast("double")).alias("value"),
        )
        for f in features
    ]
    flagged = df.select((F.col(time) >= cut).alias("current"), F.inline(F.array(*cells)))
    return flagged.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def paired_histogram(rows: DataFrame, bins: int = 20) -> DataFrame:
    """Per feature and side: density in equal bins over the joint range."""
    ends = rows.groupBy("feature").agg(
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.count_if(~F.col("current")).alias("n_reference"),
        F.count_if(F.col("current")).alias("n_current"),
    )
    counts = (
        rows.join(F.broadcast(ends.select("feature", "low", "high")), "feature")
        .groupBy("feature", _bin_of(F.col("value"), F.col("low"), F.col("high"), bins).alias("bin"))
        .agg(F.count_if(~F.col("current")).alias("a"), F.count_if(F.col("current")).alias("b"))
    )
    grid = ends.withColumn("width", (F.col("high") - F.col("low")) / bins).withColumn(
        "bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))
    )

    def density(n: str, side: str) -> Column:
        mass = F.col(f"n_{side}") * F.col("width")
        return F.when(mass > 0, F.coalesce(F.col(n), F.lit(0)) / F.when(mass > 0, mass)).alias(f"{side}_density")

    return grid.join(counts, ["feature", "bin"], "left").select(
        "feature",
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        density("a", "reference"),
        density("b", "current"),
    )


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair as (a, b, corr), each pair over its complete rows, in one scan."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y"))
        for i, a in enumerate(cols)
        for b in cols[i:]
    ]
    # One short aggregation over (pair, x, y) rows instead of a hundred buffers in a single row,
    # which is more than generated code can hold; the pair rows never leave the task.
    upper = (
        numbers.select(F.inline(F.array(*cells)))
        .filter(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("a", "b")
        .agg(pearson("x", "y").alias("corr"))
    )
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b", "corr"))).otherwise(
        F.array(F.struct("a", "b", "corr"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "corr"))
    )
    return upper.select(F.inline(both))


def with_log_columns(df: DataFrame, cols: Sequence[str] = DRIFT_FEATURES) -> DataFrame:
    """The given columns and their log1p under ``log_`` names."""
    short = {"duration_seconds": "duration"}
    return df.select(*cols, *[F.log1p(F.col(c).cast("double")).alias(f"log_{short.get(c, c)}") for c in cols])


def ks_two_sample(rows: DataFrame, slices: int | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and asymptotic p per feature.

    Rows shrink to counts per distinct value; both distribution functions are then running sums
    over range slices, so no task sees a whole sample. ``rows`` is (feature, value, current).
    """
    counts = rows.groupBy("feature", "value").agg(
        F.count_if(~F.col("current")).alias("a"), F.count_if(F.col("current")).alias("b")
    )
    cut = range_slices(counts, ["feature", "value"], slices)
    totals = cut.groupBy("feature").agg(F.sum("a").alias("n_reference"), F.sum("b").alias("n_current"))
    steps = running_totals_of_slices(cut, ["feature"], ["value"], ["a", "b"])
    gap = F.abs(F.col("cum_a") / F.col("n_reference") - F.col("cum_b") / F.col("n_current"))
    d = (
        steps.join(F.broadcast(totals), "feature")
        .filter((F.col("n_reference") > 0) & (F.col("n_current") > 0))
        .groupBy("feature", "n_reference", "n_current")
        .agg(F.max(gap).alias("ks_statistic"))
    )
    return d.withColumn("p_value", kolmogorov_p(F.col("ks_statistic"), F.col("n_reference"), F.col("n_current")))


def kolmogorov_p(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p of a two-sample statistic."""
    root = d * F.sqrt(n * m / (n + m))

    def term(k: Column) -> Column:
        sign = F.when(k % 2 == 1, 2.0).otherwise(-2.0)
        return sign * F.exp(-2.0 * k * k * root * root)

    series = F.aggregate(F.sequence(F.lit(1), F.lit(SERIES_TERMS)), F.lit(0.0), lambda acc, k: acc + term(k))
    # Below this the series has not converged and the true value is 1 to many places.
    return F.when(root < 0.2, 1.0).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def drift_verdict(tested: DataFrame, d: str = "ks_statistic", p: str = "p_value") -> DataFrame:
    """drift: significant and large; minor: significant only; else stable."""
    significant = F.col(p) < DRIFT_P
    verdict = (
        F.when(significant & (F.col(d) > DRIFT_D), "drift").when(significant, "minor").otherwise("stable")
    )
    return tested.withColumn("verdict", verdict)


def mean_shift(rows: DataFrame) -> DataFrame:
    """Mean of each side per feature and their difference."""
    reference = F.avg(F.when(~F.col("current"), F.col("value")))
    current = F.avg(F.when(F.col("current"), F.col("value")))
    return rows.groupBy("feature").agg(
        reference.alias("reference_mean"), current.alias("current_mean"), (current - reference).alias("shift")
    )


def ols_trend(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x``; nulls unless there are more than two rows."""
    n = F.regr_count(y, x)
    enough = n > 2
    return df.agg(
        n.alias("n"),
        F.when(enough, F.regr_slope(y, x)).alias("slope"),
        F.when(enough, F.regr_intercept(y, x)).alias("intercept"),
        F.when(enough, F.regr_r2(y, x)).alias("r2"),
    )
