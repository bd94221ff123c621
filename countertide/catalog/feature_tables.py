"""Feature tables and labels: M1, M4-M14."""

from __future__ import annotations

from pyspark.sql import functions as F

from countertide.catalog.logical_sql import clean
from countertide.catalog.registry import query
from countertide.catalog.scalars import DATE_SQL, TITLE_SQL, UPPERCASE
from countertide.catalog.selections import asof
from countertide.operators import features, models, pairs

_TITLE = TITLE_SQL.format(t="title")
_DATE = DATE_SQL.format(d="published_at")

VELOCITY_SQL = f"""SELECT video_id, hour_sin, hour_cos, publish_day, is_weekend, ln(1 + start_views) AS log_start_views,
       ln(1 + duration_seconds) AS log_duration, ln(1 + start_views) / ln(1 + age) AS initial_virality_slope,
       ln(1 + start_likes + 2 * start_comments) / ln(2 + start_views) AS interaction_density,
       start_likes / CAST(start_views + 1 AS DOUBLE) AS like_view_ratio,
       start_comments / CAST(start_views + 1 AS DOUBLE) AS comment_view_ratio, age AS video_age_hours,
       title_len, caps_ratio, exclamation_count, question_count, has_digits,
       CAST(coalesce(category_id, '-1') AS INTEGER) AS category_id, target_views AS views
FROM (SELECT *, {_TITLE}, {_DATE}, greatest(date_diff('microsecond', published_at, start_time) / 3.6e9, 0.5) AS age FROM pairs)"""
VELOCITY_DOUBLES = (
    "hour_sin hour_cos log_start_views log_duration initial_virality_slope interaction_density "
    "like_view_ratio comment_view_ratio video_age_hours caps_ratio"
)


@query("velocity_features", VELOCITY_SQL, doubles=VELOCITY_DOUBLES)
def _(t):
    return features.velocity_features(
        pairs.velocity_pairs(t.videos(), t.stats(), t.discovery()), uppercase=UPPERCASE
    )


@query("velocity_training_rows", f"SELECT * FROM ({VELOCITY_SQL.replace('FROM pairs)', 'FROM pairs WHERE start_views >= 10)')})", doubles=VELOCITY_DOUBLES)
def _(t):
    from countertide.operators.select import min_baseline

    pair_rows = min_baseline(pairs.velocity_pairs(t.videos(), t.stats(), t.discovery()))
    return features.velocity_features(pair_rows, uppercase=UPPERCASE)


_VIRAL_SQL = f"""raw AS (
  SELECT *, {_TITLE}, {_DATE}, date_diff('microsecond', start_time, end_time) / 3.6e9 AS hours_tracked,
         greatest(date_diff('microsecond', published_at, start_time) / 3.6e9, 0.5) AS video_age_hours
  FROM ends e JOIN videos v USING (video_id) WHERE video_id IN (SELECT video_id FROM discovery) AND snapshots >= 2),
rated AS (
  SELECT video_id, (end_views - start_views) / (hours_tracked + 0.1) AS view_velocity,
         (end_likes - start_likes) / (hours_tracked + 0.1) AS like_velocity,
         (end_comments - start_comments) / (hours_tracked + 0.1) AS comment_velocity,
         start_views, ln(1 + start_views) AS log_start_views,
         end_likes / CAST(end_views + 1 AS DOUBLE) AS like_ratio, end_comments / CAST(end_views + 1 AS DOUBLE) AS comment_ratio,
         video_age_hours, duration_seconds, hours_tracked, snapshots,
         ln(1 + start_views) / ln(1 + video_age_hours) AS initial_virality_slope,
         ln(1 + start_likes + 2 * start_comments) / ln(2 + start_views) AS interaction_density,
         hour_sin, hour_cos, title_len, caps_ratio, has_digits
  FROM raw WHERE hours_tracked >= 2)"""
_VIRAL_DOUBLES = (
    "like_velocity comment_velocity log_start_views like_ratio comment_ratio video_age_hours "
    "hours_tracked initial_virality_slope interaction_density hour_sin hour_cos caps_ratio"
)
_LABELLED = (
    "CAST(round(view_velocity, 6) >= (SELECT round(quantile_cont(view_velocity, 0.8), 6) FROM rated) AS INTEGER) AS is_viral"
)


def viral_rows(t):
    ends = features.viral_endpoints_from_tables(t.videos(), t.stats(), t.discovery())
    return features.viral_features(ends, digits=6, uppercase=UPPERCASE)


@query("viral_features", f"WITH {_VIRAL_SQL} SELECT *, {_LABELLED} FROM rated", doubles="view_velocity " + _VIRAL_DOUBLES)
def _(t):
    return viral_rows(t)


@query(
    "viral_training_matrix",
    f"WITH {_VIRAL_SQL} SELECT * EXCLUDE (view_velocity), {_LABELLED} FROM rated",
    doubles=_VIRAL_DOUBLES,
)
def _(t):
    return features.viral_training_matrix(viral_rows(t))


def _bait_sql(threshold: str, views: int) -> str:
    return f"""SELECT DISTINCT title_len, caps_ratio, exclamation_count, question_count, has_digits,
       hour_sin, hour_cos, publish_day, is_weekend,
       CAST(views > {views} AND (likes + 2 * comments) / CAST(CASE WHEN views = 0 THEN 1 ELSE views END AS DOUBLE) < {threshold} AS INTEGER) AS is_clickbait
FROM (SELECT *, {_TITLE}, {_DATE} FROM videos v JOIN latest l USING (video_id))"""


def bait_rows(t):
    joined = pairs.metadata_with_latest(t.videos(), t.stats())
    return features.clickbait_features(joined, engagement_threshold=0.0125, min_views=1000, uppercase=UPPERCASE)


@query("clickbait_features", _bait_sql("0.0125", 1000), doubles="caps_ratio hour_sin hour_cos")
def _(t):
    return bait_rows(t)


@query("clickbait_features_default", _bait_sql("0.05", 100), doubles="caps_ratio hour_sin hour_cos")
def _(t):
    return features.clickbait_features(pairs.metadata_with_latest(t.videos(), t.stats()), uppercase=UPPERCASE)


_RATIOS = """likes / CAST(CASE WHEN views = 0 THEN 1 ELSE views END AS DOUBLE) AS like_view_ratio,
       comments / CAST(CASE WHEN views = 0 THEN 1 ELSE views END AS DOUBLE) AS comment_view_ratio"""


@query(
    "clickbait_engagement",
    f"SELECT video_id, ln(1 + duration_seconds) AS log_duration, {_RATIOS}, ln(1 + views) AS log_views "
    "FROM videos JOIN latest USING (video_id)",
    doubles="log_duration like_view_ratio comment_view_ratio log_views",
)
def _(t):
    return features.clickbait_engagement_features(pairs.metadata_with_latest(t.videos(), t.stats()))


@query(
    "anomaly_features",
    f"SELECT video_id, ln(1 + views) AS log_views, {_RATIOS} FROM latest",
    doubles="log_views like_view_ratio comment_view_ratio",
)
def _(t):
    return anomaly_rows(t)


def anomaly_rows(t):
    from countertide.operators.history import latest_per_key

    return features.anomaly_features(latest_per_key(t.stats()))


@query(
    "genre_corpus",
    f"""SELECT video_id, {clean("title || ' ' || tags")} AS text, category_id AS genre FROM videos""",
)
def _(t):
    return features.genre_corpus(t.videos())


@query(
    "genre_corpus_inferred",
    f"""SELECT video_id, {clean("title || ' ' || tags")} AS text,
       CASE WHEN contains(lower(tags), 'minecraft') THEN 'Gaming' ELSE 'Vlog' END AS genre FROM videos""",
)
def _(t):
    return features.genre_corpus(t.videos().drop("category_id"))


@query("tag_transactions", "SELECT video_id, array_to_string(items, '|') AS items FROM baskets")
def _(t):
    return features.tag_transactions(t.videos())


@query(
    "heuristic_truth",
    """SELECT video_id, time, views, CAST(views > 100 AND (likes + comments) / CAST(views + 1 AS DOUBLE) < 0.05 AS INTEGER) AS clickbait_truth,
       CAST(views > 10000 AS INTEGER) AS viral_truth, 'Vlog' AS genre_truth
FROM stats JOIN videos USING (video_id)""",
)
def _(t):
    from countertide.operators.select import stats_with_metadata

    return features.heuristic_truth(stats_with_metadata(t.stats(), t.videos())).select(
        "video_id", "time", "views", "clickbait_truth", "viral_truth", "genre_truth"
    )


@query(
    "heuristic_truth_with_tags",
    """SELECT video_id, CASE WHEN contains(lower(tags), 'minecraft') THEN 'Gaming' WHEN contains(lower(tags), 'music') THEN 'Music'
            WHEN contains(lower(tags), 'tech') THEN 'Tech' WHEN contains(lower(tags), 'education') THEN 'Education'
            ELSE 'Vlog' END AS genre_truth FROM videos JOIN latest USING (video_id)""",
)
def _(t):
    return features.heuristic_truth(pairs.metadata_with_latest(t.videos(), t.stats())).select("video_id", "genre_truth")


def live_rows(t):
    """Snapshots with title signals, which are taken once per item before the join."""
    titled = features.add_title_features(t.videos().select("video_id", "title", "duration_seconds"), uppercase=UPPERCASE)
    return t.stats().join(titled.drop("title"), "video_id")


_SNAP_DATE = DATE_SQL.format(d="time")


@query(
    "evaluation_features",
    f"""SELECT video_id, time, ln(1 + views * 0.2e0) AS log_start_views, ln(1 + greatest(duration_seconds, 1)) AS log_duration,
       ln(1 + views * 0.2e0) / ln(25) AS initial_virality_slope,
       CASE WHEN views > 0 THEN ln(1 + likes + 2 * comments) / ln(2 + views) ELSE 0.0 END AS interaction_density,
       likes / CAST(views + 1 AS DOUBLE) AS like_view_ratio, comments / CAST(views + 1 AS DOUBLE) AS comment_view_ratio,
       24.0e0 AS video_age_hours, hour_sin, hour_cos, publish_day, is_weekend,
       title_len, caps_ratio, exclamation_count, question_count, has_digits, -1 AS category_id,
       views / 24.0e0 AS viral_view_velocity, likes / 24.0e0 AS viral_like_velocity, comments / 24.0e0 AS viral_comment_velocity,
       ln(1 + views) AS viral_log_start_views,
       CASE WHEN views > 0 THEN likes / CAST(views + 1 AS DOUBLE) ELSE 0.0 END AS viral_like_ratio,
       CASE WHEN views > 0 THEN comments / CAST(views + 1 AS DOUBLE) ELSE 0.0 END AS viral_comment_ratio,
       ln(1 + views) / ln(25) AS viral_initial_virality_slope, CAST(duration_seconds AS INTEGER) AS duration_seconds
FROM (SELECT *, {_TITLE}, {_SNAP_DATE} FROM stats JOIN videos USING (video_id))""",
    doubles="log_start_views log_duration initial_virality_slope interaction_density like_view_ratio comment_view_ratio "
    "video_age_hours hour_sin hour_cos caps_ratio viral_view_velocity viral_like_velocity viral_comment_velocity "
    "viral_log_start_views viral_like_ratio viral_comment_ratio viral_initial_virality_slope",
)
def _(t):
    return features.evaluation_features(live_rows(t))


@query(
    "request_features",
    f"""SELECT video_id, ln(1 + views) AS log_start_views, ln(1 + duration_seconds) AS log_duration,
       ln(1 + views) / ln(1 + greatest(age, 0.1e0)) AS initial_virality_slope,
       ln(1 + likes + 2 * comments) / ln(2 + views) AS interaction_density,
       likes / CAST(greatest(views, 1) AS DOUBLE) AS like_view_ratio, comments / CAST(greatest(views, 1) AS DOUBLE) AS comment_view_ratio,
       age AS video_age_hours, hour_sin, hour_cos, publish_day, is_weekend,
       title_len, caps_ratio, exclamation_count, question_count, has_digits, -1 AS category_id,
       views / greatest(age, 0.1e0) AS view_velocity, likes / greatest(age, 0.1e0) AS like_velocity, comments / greatest(age, 0.1e0) AS comment_velocity
FROM (SELECT *, {_TITLE}, {_DATE}, date_diff('microsecond', published_at, (SELECT max(time) FROM stats)) / 3.6e9 AS age
      FROM videos JOIN latest USING (video_id))""",
    doubles="log_start_views log_duration initial_virality_slope interaction_density like_view_ratio comment_view_ratio "
    "video_age_hours hour_sin hour_cos caps_ratio view_velocity like_velocity comment_velocity",
)
def _(t):
    return features.request_features(pairs.metadata_with_latest(t.videos(), t.stats()), asof(t), uppercase=UPPERCASE)


@query(
    "freshness_gate",
    """SELECT video_id, age_hours, age_hours <= 2 AS scorable, CASE WHEN age_hours > 2 THEN 'too_old' END AS reason
FROM (SELECT video_id, date_diff('microsecond', first_seen_at, (SELECT max(time) FROM stats)) / 3.6e9 AS age_hours FROM videos)""",
    doubles="age_hours",
)
def _(t):
    rows = t.videos().select("video_id", "first_seen_at")
    return features.freshness_gate(rows, asof(t), published="first_seen_at").drop("first_seen_at")


@query(
    "split",
    """SELECT video_id, CASE WHEN CAST('0x' || substr(md5(CAST(video_id AS VARCHAR)), 1, 8) AS BIGINT) % 5 = 0
            THEN 'test' ELSE 'train' END AS split FROM videos""",
)
def _(t):
    return models.split(t.videos().select("video_id"))


@query(
    "viral_label_share",
    f"WITH {_VIRAL_SQL} SELECT CAST(sum(is_viral) AS BIGINT) AS positives, 100.0e0 * sum(is_viral) / count(*) AS percent FROM (SELECT {_LABELLED} FROM rated)",
    doubles="percent",
)
def _(t):
    from countertide.operators.metrics import label_share

    return label_share(viral_rows(t).select(F.col("is_viral")), "is_viral")
