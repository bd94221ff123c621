"""Filters, projections, set operations and top-k."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countertide.functions import numeric
from countertide.functions.calendar import shifted
from countertide.functions.text import strip
from countertide.plans.ordered import exact_quantile

# Hours after first sight at which items are fetched again, and the slack in minutes.
FOLLOW_UP_HOURS = (24, 48, 168)
FOLLOW_UP_SLACK_MINUTES = 90

VIDEO_COLUMNS = ("video_id", "title", "tags", "duration_seconds", "published_at")


def latest_time(df: DataFrame, time: str = "time") -> dt.datetime:
    """The newest time of a table, the usual ``asof``; one value, taken from file statistics where possible."""
    return df.agg(F.max(time)).first()[0]


def _moment(asof: dt.datetime | Column, hours: float) -> Column:
    if isinstance(asof, Column):
        return shifted(asof, -hours)
    return F.lit(asof - dt.timedelta(hours=hours))


def at_or_after(df: DataFrame, asof: dt.datetime | Column, hours: float, time: str = "time") -> DataFrame:
    """Rows at or after ``asof - hours``. A ``date`` partition column is bounded too, so old folders are skipped."""
    bound = _moment(asof, hours)
    kept = df.filter(F.col(time) >= bound)
    return kept.filter(F.col("date") >= F.to_date(bound)) if "date" in df.columns else kept


def before(df: DataFrame, asof: dt.datetime | Column, hours: float, time: str = "time") -> DataFrame:
    """Rows strictly before ``asof - hours``."""
    bound = _moment(asof, hours)
    kept = df.filter(F.col(time) < bound)
    return kept.filter(F.col("date") <= F.to_date(bound)) if "date" in df.columns else kept


def scan_videos(videos: DataFrame) -> DataFrame:
    """Metadata without the category, as the text models read it."""
    return videos.select(*VIDEO_COLUMNS)


def scan_trending_history(trending: DataFrame) -> DataFrame:
    return trending.orderBy("video_id", "discovered_at", "rank")


def stats_with_metadata(stats: DataFrame, videos: DataFrame) -> DataFrame:
    """Each snapshot with its title and duration; snapshots of unknown items drop out.

    A plain inner join: Catalyst broadcasts the metadata when its measured size allows, and the
    adaptive skew join splits hot items otherwise.
    """
    return stats.join(videos.select("video_id", "title", "duration_seconds"), "video_id")


def recent_stats(stats: DataFrame, videos: DataFrame, asof: dt.datetime | Column, days: int = 7) -> DataFrame:
    """Snapshots of the last ``days`` with metadata, newest first."""
    rows = stats_with_metadata(at_or_after(stats, asof, 24 * days), videos)
    return rows.select("video_id", "title", "duration_seconds", "views", "likes", "comments", "time").orderBy(
        F.desc("time"), "video_id"
    )


def hash_ordered_sample(df: DataFrame, key: Column, n: int) -> DataFrame:
    """``n`` rows in the order of a hash of ``key``: a repeatable stand-in for an unordered limit."""
    return df.withColumn("_h", F.md5(key)).orderBy("_h").limit(n).drop("_h")


def reference_sample(
    stats: DataFrame, videos: DataFrame, asof: dt.datetime | Column, cut_hours: float = 24, n: int | None = None
) -> DataFrame:
    """Snapshots older than the cut with metadata; all of them unless ``n`` asks for a sample."""
    rows = stats_with_metadata(before(stats, asof, cut_hours), videos)
    return rows if n is None else hash_ordered_sample(rows, F.concat_ws("|", "video_id", F.unix_micros("time")), n)


def live_sample(
    stats: DataFrame, videos: DataFrame, asof: dt.datetime | Column, cut_hours: float = 24, n: int | None = None
) -> DataFrame:
    """The complement of :func:`reference_sample`."""
    rows = stats_with_metadata(at_or_after(stats, asof, cut_hours), videos)
    return rows if n is None else hash_ordered_sample(rows, F.concat_ws("|", "video_id", F.unix_micros("time")), n)


def due_followups(
    videos: DataFrame,
    asof: dt.datetime,
    lags: Sequence[int] = FOLLOW_UP_HOURS,
    slack_minutes: int = FOLLOW_UP_SLACK_MINUTES,
    first_seen: str = "first_seen_at",
) -> DataFrame:
    """Distinct ids first seen one of the ``lags`` ago, give or take the slack, both ends included.

    The few literal ranges are OR-ed in one filter, so they reach the scan as pushed filters.
    """
    slack = dt.timedelta(minutes=slack_minutes)
    due = F.lit(False)
    for hours in lags:
        middle = asof - dt.timedelta(hours=hours)
        due = due | F.col(first_seen).between(F.lit(middle - slack), F.lit(middle + slack))
    return videos.filter(due).select("video_id").distinct()


def ids_to_refetch(historical: DataFrame, new: DataFrame, key: str = "video_id") -> DataFrame:
    """Distinct historical ids that are not new."""
    return historical.select(key).distinct().join(new.select(key), key, "left_anti")


def min_baseline(pairs: DataFrame, min_views: int = 10) -> DataFrame:
    """Drop items that start too small, then keep both view counts at 0 or more."""
    kept = pairs.filter(F.col("start_views") >= min_views)
    return kept.withColumns({c: F.greatest(F.col(c), F.lit(0)) for c in ("start_views", "target_views")})


def top_percentile(df: DataFrame, col: str, p: float = 0.90, digits: int | None = None) -> DataFrame:
    """Rows at or above the exact ``p`` quantile of ``col`` (interpolated, inclusive)."""
    threshold = exact_quantile(df, col, p).scalar()
    return df.filter(F.col(col) >= (threshold if digits is None else F.round(threshold, digits)))


def complete_rows(df: DataFrame, cols: Sequence[str] = ("title", "tags")) -> DataFrame:
    """Rows without nulls in ``cols``; empty strings stay."""
    return df.dropna(subset=list(cols))


def nonempty_tags(df: DataFrame, min_rows: int | None = None) -> DataFrame:
    """Rows with tags, the title trimmed. If ``min_rows`` is asked for, fewer rows raise, as rules would mean nothing."""
    out = df
    if "tags" in df.columns:
        out = out.withColumn("tags", F.coalesce("tags", F.lit(""))).filter(strip(F.col("tags")) != "")
    if "title" in df.columns:
        out = out.withColumn("title", strip(F.coalesce("title", F.lit(""))))
    if min_rows and out.limit(min_rows).count() < min_rows:
        raise ValueError(f"fewer than {min_rows} rows with tags")
    return out


def clean_numeric(df: DataFrame, fill: float = 0.0) -> DataFrame:
    """Null, NaN and infinite values of every numeric column become ``fill``."""
    fixed = {}
    for name, kind in df.dtypes:
        if kind in ("double", "float"):
            fixed[name] = numeric.finite_or(F.col(name), fill).cast(kind)
        elif kind in ("tinyint", "smallint", "int", "bigint") or kind.startswith("decimal"):
            fixed[name] = F.coalesce(F.col(name), F.lit(fill).cast(kind))
    return df.withColumns(fixed) if fixed else df


def validation_errors(df: DataFrame, views: str = "views", duration: str = "duration_seconds", ranks: str | None = None):
    """Add ``errors``: an array with the name of each broken rule."""
    rules = []
    if views in df.columns:
        rules.append(F.when(F.col(views) < 0, F.lit("negative_views")))
    if duration in df.columns:
        rules.append(F.when(F.col(duration) <= 0, F.lit("nonpositive_duration")))
    if ranks and ranks in df.columns:
        rules.append(F.when(F.coalesce(F.size(ranks), F.lit(0)) <= 0, F.lit("empty_ranks")))
        rules.append(F.when(F.exists(ranks, lambda r: r < 1), F.lit("rank_below_one")))
    return df.withColumn("errors", F.array_compact(F.array(*rules)))


def quarantine_invalid(df: DataFrame, **columns: str) -> tuple[DataFrame, DataFrame]:
    """Split into rows that pass and rows with their list of errors."""
    marked = validation_errors(df, **columns)
    return marked.filter(F.size("errors") == 0).drop("errors"), marked.filter(F.size("errors") > 0)


# Defaults of the live evaluation.
EVALUATION_DEFAULTS = {"views": 0.0, "likes": 0.0, "comments": 0.0, "duration_seconds": 300.0, "title": ""}


def coerce_defaults(df: DataFrame, defaults: dict[str, object] = EVALUATION_DEFAULTS) -> DataFrame:
    """Missing values get their default; numbers become doubles."""
    fixed = {}
    for name, default in defaults.items():
        if name in df.columns:
            kind = "string" if isinstance(default, str) else "double"
            fixed[name] = F.coalesce(F.col(name).cast(kind), F.lit(default))
    return df.withColumns(fixed)


def newest(df: DataFrame, n: int = 50, time: str = "time", tie: str = "video_id") -> DataFrame:
    """The ``n`` newest rows; ties by key, so the result is repeatable."""
    return df.orderBy(F.desc(time), tie).limit(n)


def distinct_ids(*frames: DataFrame, key: str = "video_id") -> DataFrame:
    """Distinct ids over any number of frames."""
    ids = frames[0].select(key)
    for other in frames[1:]:
        ids = ids.union(other.select(key))
    return ids.distinct()


def id_difference(left: DataFrame, right: DataFrame, key: str = "video_id") -> DataFrame:
    """Distinct ids of ``left`` that ``right`` lacks."""
    return left.select(key).subtract(right.select(key))


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop fully equal rows; rows that differ only in their label both stay."""
    return df.distinct()


def flatten_structs(df: DataFrame, timestamp: str | None = "timestamp") -> DataFrame:
    """Struct fields as top-level columns with dotted names; ``timestamp`` is cast if it exists."""
    from pyspark.sql.types import StructType

    def leaves(schema: StructType, path: tuple[str, ...] = ()):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, StructType):
                yield from leaves(field.dataType, here)
            else:
                yield here

    cols = []
    for path in leaves(df.schema):
        value = F.col(".".join(f"`{p}`" for p in path))
        name = ".".join(path)
        cols.append((value.try_cast("timestamp") if name == timestamp else value).alias(name))
    return df.select(*cols)
