"""Feature tables, labelling rules and text corpora."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countertide.functions import calendar, numeric, text
from countertide.operators.history import endpoints, first_discovered
from countertide.operators.select import clean_numeric, coerce_defaults, complete_rows
from countertide.plans.ordered import exact_quantile
from countertide.plans.shared import freeze

# The model inputs, in model order.
VELOCITY_FEATURES = (
    "hour_sin", "hour_cos", "publish_day", "is_weekend", "log_start_views", "log_duration",
    "initial_virality_slope", "interaction_density", "like_view_ratio", "comment_view_ratio",
    "video_age_hours", "title_len", "caps_ratio", "exclamation_count", "question_count",
    "has_digits", "category_id",
)
CLICKBAIT_FEATURES = (
    "title_len", "caps_ratio", "exclamation_count", "question_count", "has_digits",
    "hour_sin", "hour_cos", "publish_day", "is_weekend",
)
VIRAL_FEATURES = (
    "like_velocity", "comment_velocity", "log_start_views", "start_views", "like_ratio", "comment_ratio",
    "video_age_hours", "duration_seconds", "hours_tracked", "snapshots", "initial_virality_slope",
    "interaction_density", "hour_sin", "hour_cos", "title_len", "caps_ratio", "has_digits",
)
ANOMALY_FEATURES = ("log_views", "like_view_ratio", "comment_view_ratio")
ENGAGEMENT_FEATURES = ("log_duration", "like_view_ratio", "comment_view_ratio", "log_views")


def _has(df: DataFrame, *cols: str) -> bool:
    return set(cols) <= set(df.columns)


def add_title_features(df: DataFrame, title: str = "title", uppercase: str = text.UPPERCASE_CLASS) -> DataFrame:
    return df.withColumns(text.title_features(F.col(title), uppercase)) if _has(df, title) else df


def add_date_features(df: DataFrame, published: str = "published_at") -> DataFrame:
    return df.withColumns(calendar.date_features(F.col(published))) if _has(df, published) else df


def add_video_age(
    df: DataFrame, start: str = "start_time", published: str = "published_at", floor: float = 0.0
) -> DataFrame:
    if not _has(df, start, published):
        return df
    return df.withColumn("video_age_hours", calendar.age_hours(F.col(published), F.col(start), floor))


def add_engagement(df: DataFrame) -> DataFrame:
    return df.withColumns(numeric.engagement_ratios(F.col("views"), F.col("likes"), F.col("comments")))


def add_growth(df: DataFrame) -> DataFrame:
    """Growth rates per tracked hour; each group is skipped when its inputs are absent."""
    if not _has(df, "hours_tracked"):
        return df
    hours = F.col("hours_tracked") + 0.1
    new: dict[str, Column] = {}
    if _has(df, "target_views", "start_views"):
        gained = F.col("target_views") - F.col("start_views")
        new["view_growth_rate"] = gained / hours
        new["log_view_growth"] = F.log1p("target_views") - F.log1p("start_views")
        new["relative_growth_rate"] = gained / (F.col("start_views") + 1)
    for one, many in (("like", "likes"), ("comment", "comments")):
        if _has(df, f"end_{many}", f"start_{many}"):
            new[f"{one}_growth_rate"] = (F.col(f"end_{many}") - F.col(f"start_{many}")) / hours
    if _has(df, "start_likes", "start_comments"):
        score = F.col("start_likes") * 1.0 + F.col("start_comments") * 3.0
        new["interaction_score"] = score
        new["interaction_velocity"] = score / hours
    return df.withColumns(new) if new else df


def add_logs(df: DataFrame) -> DataFrame:
    """Log of start views and duration, where present."""
    named = {"start_views": "log_start_views", "duration_seconds": "log_duration"}
    new = {out: F.log1p(col) for col, out in named.items() if _has(df, col)}
    return df.withColumns(new) if new else df


def velocity_features(
    pairs: DataFrame,
    target: str = "views",
    keep: Sequence[str] = ("video_id",),
    uppercase: str = text.UPPERCASE_CLASS,
) -> DataFrame:
    """Model inputs for view growth plus the target; nothing observed after the first snapshot is used."""
    views, likes, comments = F.col("start_views"), F.col("start_likes"), F.col("start_comments")
    df = add_title_features(add_date_features(pairs), uppercase=uppercase)
    df = add_logs(add_video_age(df, floor=0.5))
    df = df.withColumns(
        {
            "like_view_ratio": likes / (views + 1),
            "comment_view_ratio": comments / (views + 1),
            "initial_virality_slope": numeric.virality_slope(views, F.col("video_age_hours")),
            "interaction_density": numeric.interaction_density(views, likes, comments),
            target: F.col("target_views"),
        }
    )
    if _has(df, "category_id"):
        df = df.withColumn("category_id", F.coalesce(F.col("category_id").try_cast("int"), F.lit(-1)))
    inputs = [c for c in VELOCITY_FEATURES if _has(df, c)]
    return clean_numeric(df.select(*keep, *inputs, target))


def viral_endpoints(series: DataFrame) -> DataFrame:
    """Ends of each item's series with its metadata, from :func:`pairs.viral_series` rows."""
    measured = endpoints(series, time="stat_time")
    about = series.groupBy("video_id").agg(
        *[F.min_by(c, "stat_time").alias(c) for c in ("title", "duration_seconds", "published_at")]
    )
    return measured.join(about, "video_id")


def viral_endpoints_from_tables(videos: DataFrame, stats: DataFrame, discovery: DataFrame) -> DataFrame:
    """The same rows without building the series: aggregate first, then join one row per item."""
    about = videos.select("video_id", "title", "duration_seconds", "published_at")
    return (
        endpoints(stats)
        .join(first_discovered(discovery).select("video_id"), "video_id", "left_semi")
        .join(about, "video_id")
    )


def viral_features(
    ends: DataFrame,
    quantile: float = 0.80,
    min_hours: float = 2,
    digits: int | None = None,
    uppercase: str = text.UPPERCASE_CLASS,
) -> DataFrame:
    """Velocities, ratios and static signals per item; the top velocities are labelled viral.

    The threshold is the exact ``quantile`` over qualifying items only. ``digits`` rounds both
    sides of the comparison, for results that must agree across engines.
    """
    hours = calendar.hours_between(F.col("start_time"), F.col("end_time"))
    usable = (
        ends.filter(F.col("snapshots") >= 2)
        .withColumn("hours_tracked", hours)
        .filter(F.col("hours_tracked") >= min_hours)
    )
    per_hour = F.col("hours_tracked") + 0.1
    usable = add_title_features(add_date_features(usable), uppercase=uppercase)
    usable = add_video_age(usable, floor=0.5)
    first_views = F.col("start_views")
    rows = usable.select(
        "video_id",
        ((F.col("end_views") - first_views) / per_hour).alias("view_velocity"),
        ((F.col("end_likes") - F.col("start_likes")) / per_hour).alias("like_velocity"),
        ((F.col("end_comments") - F.col("start_comments")) / per_hour).alias("comment_velocity"),
        "start_views",
        F.log1p(first_views).alias("log_start_views"),
        (F.col("end_likes") / (F.col("end_views") + 1)).alias("like_ratio"),
        (F.col("end_comments") / (F.col("end_views") + 1)).alias("comment_ratio"),
        "video_age_hours",
        "duration_seconds",
        "hours_tracked",
        "snapshots",
        numeric.virality_slope(first_views, F.col("video_age_hours")).alias("initial_virality_slope"),
        numeric.interaction_density(first_views, F.col("start_likes"), F.col("start_comments")).alias(
            "interaction_density"
        ),
        *[c if _has(usable, c) else F.lit(0).alias(c) for c in ("hour_sin", "hour_cos", "title_len", "caps_ratio", "has_digits")],
    )
    rows = freeze(rows, "viral")  # read twice: for the threshold and for the labels
    if rows.isEmpty():
        raise ValueError("no item has two snapshots far enough apart")
    value, bound = F.col("view_velocity"), exact_quantile(rows, "view_velocity", quantile).scalar()
    if digits is not None:
        value, bound = F.round(value, digits), F.round(bound, digits)
    return rows.withColumn("is_viral", (value >= bound).cast("int"))


def viral_training_matrix(features: DataFrame, keep: Sequence[str] = ("video_id",)) -> DataFrame:
    """The 17 inputs and the label, nulls as 0; the velocity that defines the label is left out."""
    inputs = [c for c in VIRAL_FEATURES if _has(features, c)]
    filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in inputs]
    return features.select(*keep, *filled, "is_viral")


def clickbait_features(
    df: DataFrame,
    engagement_threshold: float = 0.05,
    min_views: int = 100,
    label: str = "is_clickbait",
    uppercase: str = text.UPPERCASE_CLASS,
) -> DataFrame:
    """Label high views with low engagement; keep only title and time inputs, each distinct row once.

    Engagement defines the label and is therefore never an input.
    """
    cleaned = add_engagement(clean_numeric(df))
    bait = (F.col("views") > min_views) & (F.col("engagement_score") < engagement_threshold)
    labelled = cleaned.withColumn(label, F.when(bait, 1).otherwise(0))
    rich = add_date_features(add_title_features(labelled, uppercase=uppercase))
    if not _has(rich, "hour_sin"):
        rich = rich.withColumns({"hour_sin": F.lit(0.0), "hour_cos": F.lit(0.0)})
    return rich.select(*[c for c in CLICKBAIT_FEATURES if _has(rich, c)], label).distinct()


def clickbait_engagement_features(df: DataFrame, keep: Sequence[str] = ("video_id",)) -> DataFrame:
    """Duration, ratios and views on log scales, for separating rows with conflicting labels."""
    rich = df if _has(df, "like_view_ratio") else add_engagement(df)
    rich = add_logs(rich)
    if _has(rich, "views"):
        rich = rich.withColumn("log_views", F.log1p("views"))
    return clean_numeric(rich.select(*[c for c in keep if _has(rich, c)], *[c for c in ENGAGEMENT_FEATURES if _has(rich, c)]))


def anomaly_features(df: DataFrame, keep: Sequence[str] = ("video_id",)) -> DataFrame:
    """Magnitude and two quality ratios of the newest snapshot."""
    rich = add_engagement(clean_numeric(df)).withColumn("log_views", F.log1p("views"))
    return clean_numeric(rich.select(*[c for c in keep if _has(rich, c)], *ANOMALY_FEATURES))


def genre_corpus(videos: DataFrame, keep: Sequence[str] = ("video_id",)) -> DataFrame:
    """Cleaned title and tags with the genre: the category if there is one, else the keyword rule."""
    full = complete_rows(videos, ("title", "tags"))
    genre = F.col("category_id") if _has(full, "category_id") else text.gaming_or_default(F.col("tags"))
    return full.select(*keep, text.corpus(["title", "tags"]).alias("text"), genre.alias("genre"))


def tag_transactions(df: DataFrame, key: str = "video_id", tags: str = "tags", min_items: int = 2) -> DataFrame:
    """Baskets of tags with at least ``min_items`` entries; repeats count for the size but are stored once."""
    listed = df.select(key, text.tag_list(F.col(tags)).alias("items"))
    return listed.filter(F.size("items") >= min_items).select(key, F.array_distinct("items").alias("items"))


def heuristic_truth(df: DataFrame) -> DataFrame:
    """Ground truth by rule for live evaluation: clickbait, viral and genre."""
    views, likes, comments = F.col("views"), F.col("likes"), F.col("comments")
    engagement = (likes + comments) / (views + 1)
    truth = {
        "clickbait_truth": ((views > 100) & (engagement < 0.05)).cast("int"),
        "viral_truth": (views > 10000).cast("int"),
        "genre_truth": text.keyword_genre(F.col("tags")) if _has(df, "tags") else F.lit(text.DEFAULT_GENRE),
    }
    return df.withColumns(truth)


# What live evaluation assumes about an item it has seen once.
ASSUMED_AGE_HOURS = 24.0
ASSUMED_START_SHARE = 0.2


def evaluation_features(df: DataFrame, time: str = "time", uppercase: str = text.UPPERCASE_CLASS) -> DataFrame:
    """Inputs of the velocity and viral models for single snapshots, under assumed age and start views.

    Hour and weekday are those of the snapshot. Columns of the viral model that differ from the
    velocity model carry the prefix ``viral_``. Title signals that ``df`` already carries are used
    as they are: a title is then read once per item instead of once per snapshot.
    """
    d = coerce_defaults(df)
    views, likes, comments = F.col("views"), F.col("likes"), F.col("comments")
    age = F.lit(ASSUMED_AGE_HOURS)
    seen = views > 0
    start_log = F.log1p(F.greatest(views * ASSUMED_START_SHARE, F.lit(0.0)))
    when = calendar.date_features(F.col(time))
    signals = ("title_len", "caps_ratio", "exclamation_count", "question_count", "has_digits")
    title = {c: F.col(c) for c in signals} if _has(d, *signals) else text.title_features(F.col("title"), uppercase)
    density = F.when(seen, numeric.interaction_density(views, likes, comments)).otherwise(0.0)
    return d.select(
        "video_id",
        time,
        start_log.alias("log_start_views"),
        F.log1p(F.greatest(F.col("duration_seconds"), F.lit(1.0))).alias("log_duration"),
        (start_log / F.log1p(age)).alias("initial_virality_slope"),
        density.alias("interaction_density"),
        (likes / (views + 1)).alias("like_view_ratio"),
        (comments / (views + 1)).alias("comment_view_ratio"),
        age.alias("video_age_hours"),
        *[when[c].alias(c) for c in ("hour_sin", "hour_cos", "publish_day", "is_weekend")],
        *[title[c].alias(c) for c in signals],
        F.lit(-1).alias("category_id"),
        (views / age).alias("viral_view_velocity"),
        (likes / age).alias("viral_like_velocity"),
        (comments / age).alias("viral_comment_velocity"),
        F.log1p(views).alias("viral_log_start_views"),
        F.when(seen, likes / (views + 1)).otherwise(0.0).alias("viral_like_ratio"),
        F.when(seen, comments / (views + 1)).otherwise(0.0).alias("viral_comment_ratio"),
        (F.log1p(views) / F.log1p(age)).alias("viral_initial_virality_slope"),
        F.col("duration_seconds").cast("int").alias("duration_seconds"),
    )


def request_features(
    df: DataFrame,
    asof: dt.datetime | Column,
    age_floor: float = 0.1,
    published: str = "published_at",
    uppercase: str = text.UPPERCASE_CLASS,
) -> DataFrame:
    """Inputs of the velocity and viral models for items seen once, at their age as of ``asof``.

    Ratios divide by at least 1 view, rates by an age of at least ``age_floor``; the category is unknown.
    """
    views, likes, comments = F.col("views"), F.col("likes"), F.col("comments")
    age = calendar.hours_between(F.col(published), asof if isinstance(asof, Column) else F.lit(asof))
    safe_age, safe_views = F.greatest(age, F.lit(float(age_floor))), F.greatest(views, F.lit(1))
    rich = add_date_features(add_title_features(df, uppercase=uppercase), published)
    signals = ("hour_sin", "hour_cos", "publish_day", "is_weekend")
    titles = ("title_len", "caps_ratio", "exclamation_count", "question_count", "has_digits")
    return rich.select(
        "video_id",
        F.log1p(views).alias("log_start_views"),
        F.log1p("duration_seconds").alias("log_duration"),
        numeric.virality_slope(views, safe_age).alias("initial_virality_slope"),
        numeric.interaction_density(views, likes, comments).alias("interaction_density"),
        (likes / safe_views).alias("like_view_ratio"),
        (comments / safe_views).alias("comment_view_ratio"),
        age.alias("video_age_hours"),
        *signals,
        *titles,
        F.lit(-1).alias("category_id"),
        (views / safe_age).alias("view_velocity"),
        (likes / safe_age).alias("like_velocity"),
        (comments / safe_age).alias("comment_velocity"),
    )


def freshness_gate(
    df: DataFrame, asof: dt.datetime | Column, max_age_hours: float = 2.0, published: str = "published_at"
) -> DataFrame:
    """Mark items too old to be scored as fresh, with the reason."""
    now = asof if isinstance(asof, Column) else F.lit(asof)
    age = calendar.hours_between(F.col(published), now)
    return df.withColumns(
        {
            "age_hours": age,
            "scorable": F.coalesce(age <= max_age_hours, F.lit(False)),
            "reason": F.when(age.isNull(), "no_publish_time").when(age > max_age_hours, "too_old"),
        }
    )
