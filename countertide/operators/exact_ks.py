"""Exact p values of the two-sample Kolmogorov-Smirnov statistic.

Under the null hypothesis the pooled order of both samples is a lattice path from (0, 0) to (n, m), each equally likely. The
statistic reaches d exactly if the path touches a point with |i m - j n| >= d n m. The walk goes over the anti-diagonals of
the grid and carries, for each point of the band between those borders, the probability of being there untouched; what
steps out of the band is absorbed. The sum of what is absorbed is the p value: all terms are positive, so small values
keep their digits, as one minus the paths that stay inside would not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countertide.operators.stats import kolmogorov_p
from countertide.plans.ordered import range_slices, running_totals_of_slices

#: Values a side up to which p is exact; the walk takes n + m steps over min(n, m) points at most.
EXACT_UP_TO = 10_000


def touch_probability(n: int, m: int, gap: int) -> float:
    """Probability that a random path from (0, 0) to (n, m) meets a point with |i m - j n| >= gap."""
    if gap <= 0:
        return 1.0
    if n > m:
        n, m = m, n  # the band is laid over the shorter side
    here = np.array([1.0])
    low = 0  # index i of the first point
    absorbed = 0.0
    for t in range(n + m):
        i = np.arange(low, low + len(here))
        left_i, left = n - i, float(n + m - t)
        ahead = np.zeros(len(here) + 1)
        ahead[:-1] = here * ((left - left_i) / left)
        ahead[1:] += here * (left_i / left)
        # Points of the next anti-diagonal inside the band: |i (n + m) - (t + 1) n| < gap.
        first = max((((t + 1) * n - gap) // (n + m)) + 1, 0, t + 1 - m)
        last = min(-((-((t + 1) * n + gap)) // (n + m)) - 1, n, t + 1)
        a, b = first - low, last - low + 1
        absorbed += float(ahead[: max(a, 0)].sum() + ahead[max(b, 0) :].sum())
        if first > last:
            break
        here, low = ahead[max(a, 0) : b], max(first, low)
    return min(absorbed, 1.0)


def ks_exact(rows: DataFrame, exact_up_to: int = EXACT_UP_TO, slices: int | None = None) -> DataFrame:
    """Per feature: sizes, statistic, p value and the ``method`` that gave it. ``rows`` is (feature, value, current).

    Both distribution functions are running counts over range slices of the distinct values. With at most ``exact_up_to``
    values on either side the gap is an exact whole number and p is the share of touching paths, one feature to a task;
    beyond it p is asymptotic. A feature that one side lacks has no row.
    """
    counts = rows.groupBy("feature", "value").agg(F.count_if(~F.col("current")).alias("a"), F.count_if(F.col("current")).alias("b"))
    cut = range_slices(counts, ["feature", "value"], slices)
    totals = cut.groupBy("feature").agg(F.sum("a").alias("n_reference"), F.sum("b").alias("n_current"))
    steps = running_totals_of_slices(cut, ["feature"], ["value"], ["a", "b"]).join(F.broadcast(totals), "feature")
    small = (F.col("n_reference") <= exact_up_to) & (F.col("n_current") <= exact_up_to)
    whole = F.when(small, F.abs(F.col("cum_a") * F.col("n_current") - F.col("cum_b") * F.col("n_reference")))
    share = F.abs(F.col("cum_a") / F.col("n_reference") - F.col("cum_b") / F.col("n_current"))
    tested = (
        steps.filter((F.col("n_reference") > 0) & (F.col("n_current") > 0))
        .groupBy("feature", "n_reference", "n_current")
        .agg(F.max(whole).alias("gap"), F.max(share).alias("share"))
    )

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            known = b["gap"].notna()
            p = [touch_probability(int(n), int(m), int(g)) if k else None for n, m, g, k in zip(b["n_reference"], b["n_current"], b["gap"].fillna(0), known)]
            yield b.assign(exact_p=pd.Series(p, index=b.index, dtype="float64"))

    walked = tested.repartition("feature").mapInPandas(walk, tested.schema.add("exact_p", "double"))
    n, m = F.col("n_reference"), F.col("n_current")
    d = F.when(F.col("gap").isNotNull(), F.col("gap") / n / m).otherwise(F.col("share"))
    return walked.select(
        "feature",
        "n_reference",
        "n_current",
        d.alias("ks_statistic"),
        F.when(F.col("gap").isNotNull(), F.col("exact_p")).otherwise(kolmogorov_p(F.col("share"), n, m)).alias("p_value"),
        F.when(F.col("gap").isNotNull(), "exact").otherwise("asymptotic").alias("method"),
    )
