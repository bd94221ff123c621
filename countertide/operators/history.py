"""Per-item views of a time series: first, last, endpoints, ranks and channel history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countertide.plans.ordered import mean_of_previous

COUNTERS = ("views", "likes", "comments")


def first_discovered(discovery: DataFrame, key: str = "video_id", time: str = "discovered_at") -> DataFrame:
    return discovery.groupBy(key).agg(F.min(time).alias("first_discovered"))


def snapshot_counts(stats: DataFrame, key: str = "video_id", at_least: int = 2) -> DataFrame:
    """Snapshots per item and whether there are enough of them to measure change."""
    n = F.count(F.lit(1))
    return stats.groupBy(key).agg(n.alias("snapshots"), (n >= at_least).alias("usable"))


def distinct_videos(df: DataFrame, key: str = "video_id") -> DataFrame:
    return df.agg(F.countDistinct(key).alias("videos"))


def latest_per_key(df: DataFrame, key: str = "video_id", time: str = "time", tie: Sequence[str] = ()) -> DataFrame:
    """The whole newest row of each key.

    ``max_by`` is combined map-side, so a key with very many rows is reduced before the shuffle.
    ``tie`` columns decide between rows of equal time.
    """
    return _extreme_row(F.max_by, df, key, time, tie)


def earliest_per_key(df: DataFrame, key: str = "video_id", time: str = "time", tie: Sequence[str] = ()) -> DataFrame:
    return _extreme_row(F.min_by, df, key, time, tie)


def _extreme_row(pick, df: DataFrame, key: str, time: str, tie: Sequence[str]) -> DataFrame:
    order = F.struct(time, *tie) if tie else F.col(time)
    if tie:
        return df.groupBy(key).agg(pick(F.struct("*"), order).alias("_row")).select("_row.*")
    # Column by column the buffers stay fixed-width, which keeps the hash aggregation.
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(*[pick(c, order).alias(c) for c in others])


def earliest_stats(stats: DataFrame, measures: Sequence[str] = COUNTERS) -> DataFrame:
    """First snapshot of each item under ``start_`` names."""
    return stats.groupBy("video_id").agg(
        *[F.min_by(m, "time").alias(f"start_{m}") for m in measures], F.min("time").alias("start_time")
    )


def endpoints(
    series: DataFrame, key: str = "video_id", time: str = "time", measures: Sequence[str] = COUNTERS
) -> DataFrame:
    """First and last values, their times and the number of rows, in one aggregation and one shuffle."""
    return series.groupBy(key).agg(
        F.min(time).alias("start_time"),
        F.max(time).alias("end_time"),
        F.count(F.lit(1)).alias("snapshots"),
        *[F.min_by(m, time).alias(f"start_{m}") for m in measures],
        *[F.max_by(m, time).alias(f"end_{m}") for m in measures],
    )


def rank_velocity(history: DataFrame, key: str = "video_id", rank: str = "rank", time: str = "discovered_at") -> DataFrame:
    """Change of rank per observation, negative when climbing; 0 with fewer than two observations."""
    n = F.count(F.lit(1))
    # Equal times are ordered by rank, so the result never depends on the order of rows.
    order = F.struct(time, rank)
    ends = history.groupBy(key).agg(
        F.min_by(rank, order).alias("start_rank"), F.max_by(rank, order).alias("end_rank"), n.alias("observations")
    )
    change = (F.col("end_rank") - F.col("start_rank")) / F.col("observations")
    return ends.withColumn("rank_velocity", F.when(F.col("observations") < 2, 0.0).otherwise(change))


def trending_outcome(history: DataFrame, top: int = 10, **columns: str) -> DataFrame:
    """Start rank, rank velocity, and whether the item ended within the first ``top`` places."""
    moved = rank_velocity(history, **columns)
    return moved.withColumn("is_viral", (F.col("end_rank") <= top).cast("int"))


def channel_recent_avg(
    videos: DataFrame,
    window: int = 5,
    channel: str = "channel_id",
    published: str = "published_at",
    value: str = "views",
    tie: str = "video_id",
    out: str = "channel_avg_views_recent",
) -> DataFrame:
    """Mean of the previous ``window`` items of the channel, 0 for its first item."""
    if channel not in videos.columns:
        return videos
    means = mean_of_previous(videos, [channel], [published, tie], value, window, out)
    return means.withColumn(out, F.coalesce(out, F.lit(0.0)))
