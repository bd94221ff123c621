"""Ingest of landed items: S1-S6."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from countertide.catalog.registry import query
from countertide.operators import ingest
from countertide.plans.shared import fresh_path
from countertide.sources import schemas
from countertide.sources.landing import append_stats, overwrite_dates

RUN_TIME = dt.datetime(2024, 2, 1)


def _raw(t):
    """Items spelled as the JSON a collector lands, then read back with the fixed schema."""
    d = t.videos()
    text = lambda c: F.col(c).cast("string")
    item = F.struct(
        text("video_id").alias("id"),
        F.struct(
            text("duration_seconds").alias("viewCount"),
            F.when(F.col("video_id") % 7 == 0, "n/a").otherwise((F.col("video_id") % 100).cast("string")).alias("likeCount"),
            F.when(F.col("video_id") % 2 == 0, (F.col("video_id") % 10).cast("string")).alias("commentCount"),
        ).alias("statistics"),
        F.struct(
            F.col("title"),
            F.col("title").alias("description"),
            F.split("tags", ",").alias("tags"),
            F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
            F.col("channel_id").alias("channelId"),
            F.col("category_id").alias("categoryId"),
        ).alias("snippet"),
        F.struct(
            F.concat(F.lit("PT"), (F.col("video_id") % 90).cast("string"), F.lit("M30S")).alias("duration"),
            F.lit("hd").alias("definition"),
        ).alias("contentDetails"),
        F.struct((F.col("video_id") % 5 == 0).alias("madeForKids")).alias("status"),
    )
    landed = d.select(F.to_json(item).alias("line"))
    return landed.select(F.from_json("line", schemas.RAW_ITEM).alias("item")).select("item.*")


@query(
    "ingest_video_items",
    """SELECT CAST(video_id AS VARCHAR) AS video_id, title, substr(title, 1, 2000) AS description, tags, published_at, channel_id, category_id,
       CAST(video_id % 90 * 60 + 30 AS BIGINT) AS duration_seconds, 'hd' AS definition, video_id % 5 = 0 AS made_for_kids,
       CAST(NULL AS VARCHAR) AS audio_language, CAST(NULL AS VARCHAR) AS thumbnail_url FROM videos""",
)
def _(t):
    return ingest.ingest_video_items(_raw(t))


@query(
    "ingest_stat_snapshot",
    """SELECT TIMESTAMP '2024-02-01 00:00:00' AS time, CAST(video_id AS VARCHAR) AS video_id, duration_seconds AS views,
       CAST(CASE WHEN video_id % 7 = 0 THEN 0 ELSE video_id % 100 END AS BIGINT) AS likes,
       CAST(CASE WHEN video_id % 2 = 0 THEN video_id % 10 ELSE 0 END AS BIGINT) AS comments FROM videos""",
)
def _(t):
    return ingest.ingest_stat_snapshot(_raw(t), RUN_TIME)


def _pages(t, item):
    """Result pages of up to 50 items, in id order."""
    page = t.videos().select(
        F.col("channel_id").alias("query"), F.floor(F.col("video_id") / 50).alias("page"), F.col("video_id").cast("string").alias("v"), "video_id"
    )
    listed = F.transform(F.array_sort(F.collect_list(F.struct("video_id", "v"))), item)
    return page, listed


@query("ingest_search_hits", "SELECT CAST(video_id AS VARCHAR) AS video_id, channel_id AS query, 'search' AS type FROM videos")
def _(t):
    page, listed = _pages(t, lambda x: F.struct(F.struct(x["v"].alias("videoId")).alias("id")))
    return ingest.ingest_search_hits(page.groupBy("query", "page").agg(listed.alias("items")).drop("page"))


@query(
    "ingest_trending",
    """SELECT CAST(video_id AS VARCHAR) AS video_id,
       CAST(row_number() OVER (PARTITION BY video_id // 50 ORDER BY video_id) AS INTEGER) AS rank, 'trending' AS type FROM videos""",
)
def _(t):
    page, listed = _pages(t, lambda x: F.struct(x["v"].alias("id")))
    return ingest.ingest_trending(page.groupBy("page").agg(listed.alias("items")).drop("page"))


@query(
    "insert_if_absent",
    """SELECT video_id, discovered_at, 'stored' AS origin FROM trending WHERE rank <= 10
  QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY discovered_at) = 1
UNION ALL
SELECT video_id, discovered_at, 'new' FROM discovery WHERE video_id NOT IN (SELECT video_id FROM trending WHERE rank <= 10)
  QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY discovered_at) = 1""",
)
def _(t):
    stored = t.trending().filter("rank <= 10").groupBy("video_id").agg(F.min("discovered_at").alias("discovered_at"))
    batch = t.discovery().select("video_id", "discovered_at", F.lit("new").alias("origin"))
    return ingest.insert_if_absent(
        stored.withColumn("origin", F.lit("stored")), batch, ["video_id"], prefer=F.col("discovered_at")
    )


@query("append_stats", "SELECT * FROM stats")
def _(t):
    # Every snapshot is offered twice and stored once.
    path = fresh_path(t.spark, "append")
    append_stats(t.stats().unionAll(t.stats()), path)
    return t.spark.read.parquet(path).drop("date")


@query("rewrite_dates", "SELECT * FROM stats")
def _(t):
    # The second write repeats the newest dates, as a run after a failure would.
    path = fresh_path(t.spark, "rewrite")
    overwrite_dates(t.stats(), path)
    overwrite_dates(t.stats().filter("time >= timestamp '2024-01-28 00:00:00'"), path)
    return t.spark.read.parquet(path).drop("date")
