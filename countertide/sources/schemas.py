"""Schemas of the stored tables and of a landed item."""

from __future__ import annotations

from pyspark.sql import types as T

VIDEOS = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("tags", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("channel_id", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("duration_seconds", T.LongType()),
        T.StructField("definition", T.StringType()),
        T.StructField("made_for_kids", T.BooleanType()),
        T.StructField("audio_language", T.StringType()),
        T.StructField("thumbnail_url", T.StringType()),
    ]
)

STATS = T.StructType(
    [
        T.StructField("time", T.TimestampType()),
        T.StructField("video_id", T.StringType()),
        T.StructField("views", T.LongType()),
        T.StructField("likes", T.LongType()),
        T.StructField("comments", T.LongType()),
    ]
)

# Nested schemas in the textual form that readers accept.
RAW_ITEM = (
    "id string,"
    "statistics struct<viewCount: string, likeCount: string, commentCount: string>,"
    "snippet struct<title: string, description: string, tags: array<string>, publishedAt: string,"
    " channelId: string, categoryId: string, defaultAudioLanguage: string,"
    " thumbnails: struct<high: struct<url: string>>>,"
    "contentDetails struct<duration: string, definition: string>,"
    "status struct<madeForKids: boolean>"
)

SEARCH_PAGE = "query string, items array<struct<id: struct<videoId: string>>>"
TRENDING_PAGE = "items array<struct<id: string>>"
