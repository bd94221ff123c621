"""Evaluation beyond point metrics: exact AUC, isotonic calibration, weakest segments."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countertide.plans.ordered import range_slices, running_totals, running_totals_of_slices
from countertide.plans.shared import freeze

POOL_ROWS = 100_000


def _score_counts(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and rows of each distinct score; rows without label or score are left out, NaN among them."""
    value = F.col(score).cast("double")
    known = df.filter(F.col(y).isNotNull() & value.isNotNull() & ~F.isnan(value))
    # Adding zero makes one value of both zeros.
    return known.groupBy(*by, (value + 0.0).alias("score")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(y) == 1).alias("positives"))


def exact_auc(df: DataFrame, y: str, score: str, by: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """Per group: rows, positives and the area under the ROC curve, ties counted as half.

    Rows shrink to counts per distinct score; the negatives below each score are running sums over range slices, so one hot
    score or group stays balanced. Without both classes the area is null.
    """
    counts = _score_counts(df, y, score, by).withColumn("negatives", F.col("n") - F.col("positives"))
    steps = running_totals_of_slices(range_slices(counts, [*by, "score"], slices), list(by), ["score"], ["negatives"])
    wide = "decimal(38,0)"
    twice = F.col("positives").cast("decimal(19,0)") * (2 * F.col("cum_negatives") - F.col("negatives")).cast("decimal(19,0)")
    sums = steps.groupBy(*by).agg(F.sum("n").alias("rows"), F.sum("positives").alias("positives"), F.sum(twice).alias("twice"))
    pairs = F.col("positives").cast("double") * (F.col("rows") - F.col("positives"))
    return sums.select(*by, "rows", "positives", F.when(pairs > 0, F.col("twice").cast(wide).cast("double") / 2 / F.when(pairs > 0, pairs)).alias("auc"))


def _pooled(blocks: pd.DataFrame) -> pd.DataFrame:
    """Pool neighbours until means rise. Counts are whole, so means are compared exactly."""
    kept: list[list] = []
    for low, high, n, positives in blocks.sort_values("low")[["low", "high", "n", "positives"]].itertuples(index=False):
        kept.append([low, high, int(n), int(positives)])
        while len(kept) > 1 and kept[-2][3] * kept[-1][2] >= kept[-1][3] * kept[-2][2]:
            _, high, n, positives = kept.pop()
            kept[-1][1:] = [high, kept[-1][2] + n, kept[-1][3] + positives]
    return pd.DataFrame(kept, columns=["low", "high", "n", "positives"])


def isotonic_calibration(df: DataFrame, y: str, score: str, pool_rows: int = POOL_ROWS) -> DataFrame:
    """Blocks of scores with one calibrated probability each: the best rising fit, (low, high, n, positives, calibrated).

    Adjacent violators may be pooled in any order. Scores are numbered and cut into pieces of ``pool_rows``, which are pooled
    each in a task; then pieces are cut half a piece further on, so that their borders come to lie inside, until no border
    is violated. Pooled rows become one, so a block over many pieces needs few turns.
    """
    counts = _score_counts(df, y, score)
    blocks = freeze(counts.select(F.col("score").alias("low"), F.col("score").alias("high"), "n", "positives"), "scores")
    shift = 0
    while True:
        placed = running_totals(blocks.withColumn("_one", F.lit(1)), [], ["low"], ["_one"], "_cum_")
        piece = F.floor((F.col("_cum__one") - 1 + shift) / pool_rows).cast("bigint")
        pooled = placed.withColumn("_piece", piece).groupBy("_piece").applyInPandas(_pooled, "low double, high double, n bigint, positives bigint")
        blocks = freeze(pooled, "pooled")
        if not _has_violation(blocks):
            return blocks.withColumn("calibrated", F.col("positives") / F.col("n"))
        shift = 0 if shift else max(1, pool_rows // 2)


def _has_violation(blocks: DataFrame) -> bool:
    """Whether a block's mean does not exceed that of the block before it."""
    cut = range_slices(blocks, ["low"])
    inside = Window.partitionBy("_slice").orderBy("low")
    mean = F.col("positives") / F.col("n")
    local = cut.select((mean <= F.lag(mean).over(inside)).alias("bad")).filter("bad")
    if local.head(1):
        return True
    ends = cut.groupBy("_slice").agg(F.min_by(mean, "low").alias("first"), F.max_by(mean, "low").alias("last"))  # one row a slice
    over = Window.orderBy("_slice")
    return bool(ends.select((F.col("first") <= F.lag("last").over(over)).alias("bad")).filter("bad").head(1))


def segment_bins(df: DataFrame, numeric: Sequence[str], parts: int = 4) -> dict[str, list[float]]:
    """Inner quantile borders of each numeric feature, from one sketch."""
    shares = [k / parts for k in range(1, parts)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(c) for c in numeric]).head()
    return {c: sorted(set(row[c] or [])) for c in numeric}


def weak_segments(
    df: DataFrame, loss: Column, numeric: Sequence[str], categories: Sequence[str] = (), parts: int = 4, min_share: float = 0.05
) -> DataFrame:
    """Mean loss of the segments made by one or two features, against that of all rows, worst first.

    Numeric features are cut at their quantiles; null is a segment of its own. One pass sums the loss over all segments of the
    cube, combined map-side. Segments below ``min_share`` of the rows are left out.
    """
    borders = segment_bins(df, numeric, parts) if numeric else {}
    cells = {}
    for c in numeric:
        place = sum(((F.col(c).cast("double") > b).cast("int") for b in borders[c]), F.lit(0))
        cells[c] = F.when(F.col(c).isNotNull(), place.cast("string"))
    for c in categories:
        cells[c] = F.col(c).cast("string")
    names = [*numeric, *categories]
    null = F.lit(None).cast("string")
    segments = [
        F.struct(F.lit(a).alias("feature_a"), cells[a].alias("segment_a"), (F.lit(b) if b else null).alias("feature_b"), (cells[b] if b else null).alias("segment_b"))
        for a, b in [*((c, None) for c in names), *combinations(names, 2)]
    ]
    known = df.withColumn("_loss", loss.cast("double")).filter(F.col("_loss").isNotNull())
    keys = ["feature_a", "segment_a", "feature_b", "segment_b"]
    sums = known.select("_loss", F.inline(F.array(*segments))).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("_loss").alias("loss"))
    total = known.agg(F.count(F.lit(1)).alias("n"), F.avg("_loss").alias("loss"))
    rows, overall = total.select("n").scalar(), total.select("loss").scalar()
    return (
        sums.filter(F.col("n") >= F.lit(min_share) * rows)
        .select(*keys, "n", "loss", (F.col("loss") - overall).alias("excess"))
        .orderBy(F.desc("excess"), *[F.asc_nulls_first(k) for k in keys])
    )
