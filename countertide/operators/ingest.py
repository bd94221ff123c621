"""From landed items to the stored tables: flattening, discovery logs, idempotent inserts, retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countertide.functions import calendar, text
from countertide.operators.select import at_or_after

# Fixed value: longest stored description, in characters.
DESCRIPTION_LENGTH = 2000


def ingest_video_items(raw: DataFrame) -> DataFrame:
    """Nested item to one flat metadata row of twelve fields."""
    snippet, content = F.col("snippet"), F.col("contentDetails")
    blank = F.lit("")
    return raw.select(
        F.col("id").alias("video_id"),
        F.coalesce(snippet["title"], blank).alias("title"),
        F.substring(F.coalesce(snippet["description"], blank), 1, DESCRIPTION_LENGTH).alias("description"),
        text.joined_tags(snippet["tags"]).alias("tags"),
        calendar.iso_timestamp(snippet["publishedAt"]).alias("published_at"),
        snippet["channelId"].alias("channel_id"),
        snippet["categoryId"].alias("category_id"),
        calendar.duration_seconds(content["duration"]).alias("duration_seconds"),
        content["definition"].alias("definition"),
        F.col("status")["madeForKids"].alias("made_for_kids"),
        snippet["defaultAudioLanguage"].alias("audio_language"),
        snippet["thumbnails"]["high"]["url"].alias("thumbnail_url"),
    )


def ingest_stat_snapshot(raw: DataFrame, now: Column | dt.datetime) -> DataFrame:
    """Counters of each item at one run time; a missing or unreadable counter is 0."""
    run_time = now if isinstance(now, Column) else F.lit(now)

    def counter(name: str) -> Column:
        return F.coalesce(F.col("statistics")[name].try_cast("bigint"), F.lit(0).cast("bigint"))

    return raw.select(
        run_time.alias("time"),
        F.col("id").alias("video_id"),
        counter("viewCount").alias("views"),
        counter("likeCount").alias("likes"),
        counter("commentCount").alias("comments"),
    )


def ingest_search_hits(pages: DataFrame) -> DataFrame:
    """One row per found item with the query that found it; repeats across queries stay."""
    hit = pages.select("query", F.explode("items").alias("item"))
    return hit.select(F.col("item.id.videoId").alias("video_id"), "query", F.lit("search").alias("type"))


def ingest_trending(pages: DataFrame) -> DataFrame:
    """One row per listed item with its rank, which starts at 1."""
    listed = pages.select(F.posexplode("items").alias("pos", "item"))
    return listed.select(
        F.col("item.id").alias("video_id"), (F.col("pos") + 1).alias("rank"), F.lit("trending").alias("type")
    )


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], prefer: Column | None = None) -> DataFrame:
    """Rows of ``batch`` whose key ``target`` lacks, one per key.

    ``prefer`` decides which of several batch rows with one key is first (the smallest wins);
    it is aggregated map-side, so many copies of one key cost nothing extra downstream.
    """
    names = list(keys)
    if prefer is None:
        single = batch.dropDuplicates(names)
    else:
        single = batch.groupBy(*names).agg(F.min_by(F.struct("*"), prefer).alias("_row")).select("_row.*")
    return single.join(target.select(*names), names, "left_anti")


def insert_if_absent(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], prefer: Column | None = None
) -> DataFrame:
    """Upsert in which the first write wins: stored rows are never refreshed."""
    return target.unionByName(new_rows(target, batch, keys, prefer))


def union_intents(search: DataFrame, trending: DataFrame) -> DataFrame:
    """Both discovery logs in one bag; fields that one side lacks are null."""
    return search.unionByName(trending, allowMissingColumns=True)


def route_intents(intents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the joint log into search and trending rows; other types belong to neither."""
    search = intents.filter(F.col("type") == "search").select("video_id", "query")
    trending = intents.filter(F.col("type") == "trending").select("video_id", "rank")
    return search, trending


def apply_retention(stats: DataFrame, asof: dt.datetime | Column, days: int = 60, time: str = "time") -> DataFrame:
    """Rows not older than ``days`` before ``asof``; whole dates drop out by partition pruning."""
    return at_or_after(stats, asof, hours=24 * days, time=time)
