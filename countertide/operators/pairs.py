"""Training pairs: joins of metadata, discovery and the ends of each series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countertide.functions.calendar import hours_between, longer_than, shifted
from countertide.operators.history import earliest_stats, endpoints, first_discovered, latest_per_key
from countertide.operators.select import scan_videos
from countertide.plans.skew import join_spreading_hot_keys


def metadata_with_latest(videos: DataFrame, stats: DataFrame) -> DataFrame:
    """Metadata with the newest snapshot; items without snapshots drop out."""
    return scan_videos(videos).join(latest_per_key(stats), "video_id")


def velocity_pairs(videos: DataFrame, stats: DataFrame, discovery: DataFrame, min_hours: float = 2) -> DataFrame:
    """Discovered items tracked for more than ``min_hours``, with first and last counters, newest discovery first.

    The series is aggregated before any join, and the three inputs meet on one key, so each is
    shuffled once and the metadata joins one row per item.
    """
    ends = endpoints(stats).filter(longer_than(F.col("start_time"), F.col("end_time"), min_hours))
    joined = first_discovered(discovery).join(ends, "video_id").join(videos, "video_id")
    return joined.select(
        "video_id",
        "title",
        "tags",
        "duration_seconds",
        "published_at",
        "channel_id",
        "category_id",
        "first_discovered",
        "start_views",
        "start_likes",
        "start_comments",
        "start_time",
        F.col("end_views").alias("target_views"),
        "end_likes",
        "end_comments",
        "end_time",
        hours_between(F.col("start_time"), F.col("end_time")).alias("hours_tracked"),
    ).orderBy(F.desc("first_discovered"), "video_id")


def flexible_pairs(videos: DataFrame, stats: DataFrame, min_hours: float = 1) -> DataFrame:
    """First against last snapshot of any item tracked for more than ``min_hours``; the start time is kept."""
    ends = endpoints(stats).filter(longer_than(F.col("start_time"), F.col("end_time"), min_hours))
    return ends.join(videos, "video_id").select(
        "video_id",
        "title",
        "duration_seconds",
        "published_at",
        "channel_id",
        "start_views",
        "start_likes",
        "start_comments",
        "start_time",
        F.col("end_views").alias("target_views"),
        hours_between(F.col("start_time"), F.col("end_time")).alias("hours_between"),
    )


def velocity_pairs_or_fallback(videos: DataFrame, stats: DataFrame, discovery: DataFrame, min_hours: float = 2) -> DataFrame:
    """:func:`velocity_pairs`, or :func:`flexible_pairs` when there are none; the choice needs one cheap action."""
    strict = velocity_pairs(videos, stats, discovery, min_hours)
    # The sort does not matter for the emptiness test, and dropping it lets the test stop early.
    if not strict.select("video_id").isEmpty():
        return strict
    flexible = flexible_pairs(videos, stats)
    if flexible.select("video_id").isEmpty():
        raise ValueError("no training pairs")
    return flexible


def target_window_pairs(
    videos: DataFrame, stats: DataFrame, target_hours: float = 168, window_hours: float = 24
) -> DataFrame:
    """First snapshot, and the last one inside publish time + target hours, give or take the window.

    The range test is a residual of an equi join. That join feeds an aggregation on its own key,
    so hot items are dealt over several partitions first and combined map-side afterwards.
    """
    published = videos.select("video_id", "published_at")
    near = join_spreading_hot_keys(
        stats.select("video_id", "time", "views"), published, "video_id", spread_on="time"
    ).filter(
        F.col("time").between(
            shifted(F.col("published_at"), target_hours - window_hours),
            shifted(F.col("published_at"), target_hours + window_hours),
        )
    )
    target = near.groupBy("video_id").agg(
        F.max_by("views", "time").alias("target_views"), F.max("time").alias("target_time")
    )
    return (
        target.join(earliest_stats(stats), "video_id")
        .join(videos, "video_id")
        .select(
            "video_id",
            "title",
            "duration_seconds",
            "published_at",
            "channel_id",
            "start_views",
            "start_likes",
            "start_comments",
            "start_time",
            "target_views",
            "target_time",
        )
    )


def viral_series(videos: DataFrame, stats: DataFrame, discovery: DataFrame) -> DataFrame:
    """Every snapshot of discovered items with metadata, in item and time order."""
    known = first_discovered(discovery).join(
        videos.select("video_id", "title", "duration_seconds", "published_at"), "video_id"
    )
    return (
        stats.join(known, "video_id")
        .select(
            "video_id",
            "title",
            "duration_seconds",
            "published_at",
            "first_discovered",
            F.col("time").alias("stat_time"),
            "views",
            "likes",
            "comments",
        )
        .orderBy("video_id", "stat_time")
    )
