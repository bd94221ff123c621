"""Windows and joins: W1-W6, J1-J10, A1-A3."""

from __future__ import annotations

from pyspark.sql import functions as F

from countertide.catalog.registry import query
from countertide.operators import history, pairs, select


@query(
    "velocity_pairs",
    "SELECT * FROM pairs ORDER BY first_discovered DESC, video_id",
    doubles="hours_tracked",
)
def _(t):
    return pairs.velocity_pairs(t.videos(), t.stats(), t.discovery())


@query("latest_stats", "SELECT * FROM latest")
def _(t):
    return history.latest_per_key(t.stats())


@query(
    "earliest_stats",
    "SELECT video_id, views AS start_views, likes AS start_likes, comments AS start_comments, time AS start_time "
    "FROM stats QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY time) = 1",
)
def _(t):
    return history.earliest_stats(t.stats())


@query(
    "channel_recent_avg",
    """SELECT video_id, channel_id, published_at, views,
       coalesce(avg(views) OVER (PARTITION BY channel_id ORDER BY published_at, video_id
                                 ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 0) AS channel_avg_views_recent
FROM (SELECT v.video_id, v.channel_id, v.published_at, v.duration_seconds AS views FROM videos v)""",
    doubles="channel_avg_views_recent",
)
def _(t):
    rows = t.videos().select("video_id", "channel_id", "published_at", F.col("duration_seconds").alias("views"))
    return history.channel_recent_avg(rows)


@query("endpoints", "SELECT * FROM ends")
def _(t):
    return history.endpoints(t.stats())


_MOVES = """SELECT video_id, arg_min(rank, (discovered_at, rank)) AS start_rank,
       arg_max(rank, (discovered_at, rank)) AS end_rank, count(*) AS observations
FROM trending GROUP BY video_id"""

@query(
    "rank_velocity",
    f"""SELECT *, CASE WHEN observations < 2 THEN 0.0
            ELSE CAST(end_rank - start_rank AS DOUBLE) / observations END AS rank_velocity
FROM ({_MOVES})""",
    doubles="rank_velocity",
)
def _(t):
    return history.rank_velocity(t.trending())


@query(
    "trending_outcome",
    f"""SELECT *, CASE WHEN observations < 2 THEN 0.0
            ELSE CAST(end_rank - start_rank AS DOUBLE) / observations END AS rank_velocity,
       CAST(end_rank <= 10 AS INTEGER) AS is_viral
FROM ({_MOVES})""",
    doubles="rank_velocity",
)
def _(t):
    return history.trending_outcome(t.trending())


@query(
    "metadata_latest",
    "SELECT v.video_id, v.title, v.tags, v.duration_seconds, v.published_at, l.time, l.views, l.likes, l.comments "
    "FROM videos v JOIN latest l USING (video_id)",
)
def _(t):
    return pairs.metadata_with_latest(t.videos(), t.stats())


@query(
    "viral_series",
    """SELECT v.video_id, v.title, v.duration_seconds, v.published_at, f.first_discovered,
       s.time AS stat_time, s.views, s.likes, s.comments
FROM first_found f JOIN videos v USING (video_id) JOIN stats s USING (video_id)
ORDER BY video_id, stat_time""",
)
def _(t):
    return pairs.viral_series(t.videos(), t.stats(), t.discovery())


@query(
    "target_window_pairs",
    """SELECT v.video_id, v.title, v.duration_seconds, v.published_at, v.channel_id, e.start_views, e.start_likes,
       e.start_comments, e.start_time, g.views AS target_views, g.time AS target_time
FROM videos v JOIN ends e USING (video_id)
JOIN (SELECT s.video_id, s.views, s.time FROM stats s JOIN videos w USING (video_id)
      WHERE s.time BETWEEN w.published_at + INTERVAL 144 HOUR AND w.published_at + INTERVAL 192 HOUR
      QUALIFY row_number() OVER (PARTITION BY s.video_id ORDER BY s.time DESC) = 1) g USING (video_id)""",
)
def _(t):
    return pairs.target_window_pairs(t.videos(), t.stats())


@query(
    "flexible_pairs",
    """SELECT v.video_id, v.title, v.duration_seconds, v.published_at, v.channel_id, e.start_views, e.start_likes,
       e.start_comments, e.start_time, e.end_views AS target_views,
       date_diff('microsecond', e.start_time, e.end_time) / 3.6e9 AS hours_between
FROM videos v JOIN ends e USING (video_id) WHERE e.end_time > e.start_time + INTERVAL 1 HOUR""",
    doubles="hours_between",
)
def _(t):
    return pairs.flexible_pairs(t.videos(), t.stats())


@query(
    "stats_with_metadata",
    "SELECT s.video_id, s.time, s.views, s.likes, s.comments, v.title, v.duration_seconds "
    "FROM stats s JOIN videos v USING (video_id)",
)
def _(t):
    return select.stats_with_metadata(t.stats(), t.videos())


@query(
    "refetch_ids",
    "SELECT DISTINCT video_id FROM discovery WHERE video_id NOT IN (SELECT video_id FROM trending WHERE rank <= 5)",
)
def _(t):
    return select.ids_to_refetch(t.discovery(), t.trending().filter("rank <= 5"))


@query(
    "velocity_pairs_or_fallback",
    "SELECT * FROM pairs ORDER BY first_discovered DESC, video_id",
    doubles="hours_tracked",
)
def _(t):
    return pairs.velocity_pairs_or_fallback(t.videos(), t.stats(), t.discovery())


@query(
    "velocity_fallback_taken",
    """SELECT v.video_id, v.title, v.duration_seconds, v.published_at, v.channel_id, e.start_views, e.start_likes,
       e.start_comments, e.start_time, e.end_views AS target_views,
       date_diff('microsecond', e.start_time, e.end_time) / 3.6e9 AS hours_between
FROM videos v JOIN ends e USING (video_id) WHERE e.end_time > e.start_time + INTERVAL 1 HOUR""",
    doubles="hours_between",
)
def _(t):
    # No series is that long, so the strict pairs are empty and the fallback is used.
    return pairs.velocity_pairs_or_fallback(t.videos(), t.stats(), t.discovery(), min_hours=24 * 365)


@query("first_discovered", "SELECT * FROM first_found")
def _(t):
    return history.first_discovered(t.discovery())


@query("snapshot_counts", "SELECT video_id, count(*) AS snapshots, count(*) >= 2 AS usable FROM stats GROUP BY video_id")
def _(t):
    return history.snapshot_counts(t.stats())


@query("distinct_videos", "SELECT count(DISTINCT video_id) AS videos FROM stats")
def _(t):
    return history.distinct_videos(t.stats())
