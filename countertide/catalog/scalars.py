"""Scalar functions: F1-F24."""

from __future__ import annotations

from pyspark.sql import functions as F

from countertide.catalog.logical_sql import clean
from countertide.catalog.registry import query
from countertide.functions import calendar, numeric, text
from countertide.operators import features, pairs, select

# The SQL engine's patterns know \p{Lu} only.
UPPERCASE = r"\p{Lu}"

TITLE_SQL = r"""CAST(length({t}) AS INTEGER) AS title_len,
       CAST(length(regexp_replace({t}, '[^\p{{Lu}}]+', '', 'g')) AS INTEGER) AS caps_count,
       length(regexp_replace({t}, '[^\p{{Lu}}]+', '', 'g')) / CAST(length({t}) + 1 AS DOUBLE) AS caps_ratio,
       CAST(length(regexp_replace({t}, '[^!]+', '', 'g')) AS INTEGER) AS exclamation_count,
       CAST(length(regexp_replace({t}, '[^?]+', '', 'g')) AS INTEGER) AS question_count,
       CAST(regexp_matches({t}, '\p{{Nd}}') AS INTEGER) AS has_digits"""
DATE_SQL = """CAST(hour({d}) AS INTEGER) AS publish_hour, CAST(isodow({d}) - 1 AS INTEGER) AS publish_day,
       CAST(isodow({d}) >= 6 AS INTEGER) AS is_weekend, sin(2 * pi() * hour({d}) / 24) AS hour_sin,
       cos(2 * pi() * hour({d}) / 24) AS hour_cos"""


@query(
    "title_features",
    f"SELECT doc_id, {TITLE_SQL.format(t='text')} FROM documents",
    doubles="caps_ratio",
)
def _(t):
    rows = t.given("documents").select("doc_id", F.col("text").alias("title"))
    return features.add_title_features(rows, uppercase=UPPERCASE).drop("title")


@query("clean_text", f"SELECT doc_id, {clean('text')} AS cleaned FROM documents")
def _(t):
    return t.given("documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query("corpus", f"""SELECT video_id, {clean("title || ' ' || tags")} AS text FROM videos""")
def _(t):
    return t.videos().select("video_id", text.corpus(["title", "tags"]).alias("text"))


@query(
    "joined_lower_text",
    "SELECT video_id, trim(lower(coalesce(title, '') || ' ' || array_to_string(string_split(tags, ','), ' ')), "
    "chr(32)||chr(9)||chr(10)||chr(13)||chr(11)||chr(12)) AS text FROM videos",
)
def _(t):
    return t.videos().select(
        "video_id", text.joined_lower(F.col("title"), F.split("tags", ",")).alias("text")
    )


@query(
    "tag_list",
    """SELECT doc_id, array_to_string(items, '|') AS items, CAST(len(items) AS INTEGER) AS n
FROM (SELECT doc_id, list_filter(list_transform(string_split(text, ','), lambda t: lower(trim(t, chr(32)||chr(9)||chr(10)||chr(13)||chr(11)||chr(12)))),
                                 lambda t: t <> '') AS items FROM documents)""",
)
def _(t):
    listed = t.given("documents").select("doc_id", text.tag_list(F.col("text")).alias("items"))
    return listed.withColumn("n", F.size("items"))


@query("date_features", f"SELECT event_id, {DATE_SQL.format(d='ts')} FROM events", doubles="hour_sin hour_cos")
def _(t):
    return features.add_date_features(t.events().select("event_id", "ts"), "ts").drop("ts")


@query(
    "video_age",
    """SELECT e.video_id, greatest(date_diff('microsecond', v.published_at, e.start_time) / 3.6e9, 0.0) AS video_age_hours
FROM ends e JOIN videos v USING (video_id)""",
    doubles="video_age_hours",
)
def _(t):
    rows = pairs.flexible_pairs(t.videos(), t.stats(), min_hours=-1)
    return features.add_video_age(rows).select("video_id", "video_age_hours")


@query(
    "engagement",
    """SELECT video_id, time, likes / CAST(b AS DOUBLE) AS like_view_ratio, comments / CAST(b AS DOUBLE) AS comment_view_ratio,
       (likes + 2 * comments) / CAST(b AS DOUBLE) AS engagement_score,
       CASE WHEN views <= 0 THEN 0.0 ELSE (likes + 2 * comments) / CAST(views AS DOUBLE) END AS score_or_zero
FROM (SELECT *, CASE WHEN views = 0 THEN 1 ELSE views END AS b FROM stats)""",
    doubles="like_view_ratio comment_view_ratio engagement_score score_or_zero",
)
def _(t):
    v, li, c = F.col("views"), F.col("likes"), F.col("comments")
    return features.add_engagement(t.stats()).select(
        "video_id",
        "time",
        "like_view_ratio",
        "comment_view_ratio",
        "engagement_score",
        numeric.engagement_or_zero(v, li, c).alias("score_or_zero"),
    )


@query(
    "growth",
    """SELECT video_id, (target_views - start_views) / h AS view_growth_rate,
       ln(1 + target_views) - ln(1 + start_views) AS log_view_growth,
       (target_views - start_views) / CAST(start_views + 1 AS DOUBLE) AS relative_growth_rate,
       (end_likes - start_likes) / h AS like_growth_rate, (end_comments - start_comments) / h AS comment_growth_rate,
       start_likes * 1.0e0 + start_comments * 3.0e0 AS interaction_score,
       (start_likes * 1.0e0 + start_comments * 3.0e0) / h AS interaction_velocity
FROM (SELECT *, CAST(hours_tracked + 0.1 AS DOUBLE) AS h FROM pairs)""",
    doubles="view_growth_rate log_view_growth relative_growth_rate like_growth_rate comment_growth_rate interaction_score interaction_velocity",
)
def _(t):
    grown = features.add_growth(pairs.velocity_pairs(t.videos(), t.stats(), t.discovery()))
    return grown.select(
        "video_id",
        "view_growth_rate",
        "log_view_growth",
        "relative_growth_rate",
        "like_growth_rate",
        "comment_growth_rate",
        "interaction_score",
        "interaction_velocity",
    )


@query(
    "log_features",
    """SELECT video_id, ln(1 + start_views) AS log_start_views, ln(1 + duration_seconds) AS log_duration,
       ln(1 + start_views) / ln(1 + age) AS initial_virality_slope,
       ln(1 + start_likes + 2 * start_comments) / ln(2 + start_views) AS interaction_density
FROM (SELECT *, greatest(date_diff('microsecond', published_at, start_time) / 3.6e9, 0.5) AS age FROM pairs)""",
    doubles="log_start_views log_duration initial_virality_slope interaction_density",
)
def _(t):
    df = features.add_logs(pairs.velocity_pairs(t.videos(), t.stats(), t.discovery()))
    age = calendar.age_hours(F.col("published_at"), F.col("start_time"), 0.5)
    return df.select(
        "video_id",
        "log_start_views",
        "log_duration",
        numeric.virality_slope(F.col("start_views"), age).alias("initial_virality_slope"),
        numeric.interaction_density(F.col("start_views"), F.col("start_likes"), F.col("start_comments")).alias(
            "interaction_density"
        ),
    )


@query(
    "duration_parse",
    "SELECT event_id, CAST(user_id % 3 * 86400 + event_id % 24 * 3600 + user_id % 60 * 60 + event_id % 60 AS BIGINT) AS seconds FROM events",
)
def _(t):
    # Durations are spelled from the event keys, so the parsed value is known.
    e, u = F.col("event_id"), F.col("user_id")
    spelled = F.concat(
        F.lit("P"), (u % 3).cast("string"), F.lit("DT"), (e % 24).cast("string"), F.lit("H"),
        (u % 60).cast("string"), F.lit("M"), (e % 60).cast("string"), F.lit("S"),
    )
    return t.events().select("event_id", calendar.duration_seconds(spelled).alias("seconds"))


@query("iso_timestamp", "SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def _(t):
    spelled = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return t.events().select("event_id", calendar.iso_timestamp(spelled).alias("parsed"))


_ID_SQL = (
    r"CASE WHEN length({u}) = 11 AND position(' ' IN {u}) = 0 THEN {u} ELSE "
    r"coalesce(nullif(regexp_extract({u}, '(?:v=|/)([0-9A-Za-z_-]{{11}})', 1), ''), "
    r"nullif(regexp_extract({u}, '(?:youtu\.be/)([0-9A-Za-z_-]{{11}})', 1), ''), "
    r"nullif(regexp_extract({u}, '(?:embed/)([0-9A-Za-z_-]{{11}})', 1), '')) END"
)


@query(
    "video_id",
    "SELECT page_id, " + _ID_SQL.format(u="url") + " AS raw_id, "
    + _ID_SQL.format(u="built") + " AS built_id, " + _ID_SQL.format(u="substr(md5(CAST(page_id AS VARCHAR)), 1, 11)")
    + " AS own_id, 'https://www.youtube.com/watch?v=' || " + _ID_SQL.format(u="built") + " AS link "
    "FROM (SELECT *, 'https://v.example/watch?v=' || substr(md5(CAST(page_id AS VARCHAR)), 1, 11) AS built FROM pages)",
)
def _(t):
    key = F.substring(F.md5(F.col("page_id").cast("string")), 1, 11)
    built = F.concat(F.lit("https://v.example/watch?v="), key)
    return t.given("pages").select(
        "page_id",
        text.video_id_of(F.col("url")).alias("raw_id"),
        text.video_id_of(built).alias("built_id"),
        text.video_id_of(key).alias("own_id"),
        text.video_link(text.video_id_of(built)).alias("link"),
    )


@query(
    "genre_rules",
    """SELECT doc_id, CASE WHEN contains(lower(text), 'minecraft') THEN 'Gaming' ELSE 'Vlog' END AS training_genre,
       CASE WHEN contains(lower(text), 'minecraft') THEN 'Gaming' WHEN contains(lower(text), 'music') THEN 'Music'
            WHEN contains(lower(text), 'tech') THEN 'Tech' WHEN contains(lower(text), 'education') THEN 'Education'
            ELSE 'Vlog' END AS evaluation_genre
FROM documents""",
)
def _(t):
    return t.given("documents").select(
        "doc_id",
        text.gaming_or_default(F.col("text")).alias("training_genre"),
        text.keyword_genre(F.col("text")).alias("evaluation_genre"),
    )


@query(
    "number_format",
    """SELECT video_id, time, CASE WHEN x >= 1000000 THEN printf('%.1fM', x / 1e6) WHEN x >= 1000 THEN printf('%.1fK', x / 1e3)
       ELSE CAST(x AS VARCHAR) END AS shown
FROM (SELECT video_id, time, views * 25 AS x FROM stats)""",
)
def _(t):
    return t.stats().select("video_id", "time", numeric.display_number(F.col("views") * 25).alias("shown"))


@query(
    "safe_log_clip",
    "SELECT video_id, time, exp(least(greatest((views - 500) / 100.0e0, 0), 25)) / 1e6 - 1e-6 AS real_millions FROM stats",
    doubles="real_millions",
)
def _(t):
    return t.stats().select(
        "video_id",
        "time",
        (numeric.from_bounded_log((F.col("views") - 500) / F.lit(100.0)) / 1e6).alias("real_millions"),
    )


@query(
    "joined_tags",
    "SELECT video_id, tags AS joined, lower(CAST(duration_seconds % 2 = 0 AS VARCHAR)) IN ('true', '1', 'yes') AS flag FROM videos",
)
def _(t):
    return t.videos().select(
        "video_id",
        text.joined_tags(text.tag_list(F.col("tags"))).alias("joined"),
        text.truthy((F.col("duration_seconds") % 2 == 0).cast("string")).alias("flag"),
    )


@query(
    "flatten_structs",
    """SELECT event_id AS "event.event_id", CAST(json_extract(props, '$.k') AS INTEGER) AS "event.detail.k",
       ts AS timestamp FROM events""",
)
def _(t):
    detail = F.from_json("props", "k int").alias("detail")
    nested = t.events().select(F.struct("event_id", detail).alias("event"), F.col("ts").alias("timestamp"))
    return select.flatten_structs(nested)
