"""Streaming jobs run to the end of the stored series: R1-R4."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from countertide.catalog.registry import query
from countertide.operators.history import endpoints
from countertide.plans.shared import fresh_path
from countertide.sources import landing, retention
from countertide.streaming import jobs


def _landed(t, copies: int = 1):
    """The snapshots as a folder of files, several of which make one micro-batch."""
    path = fresh_path(t.spark, "landed")
    rows = t.stats()
    for _ in range(copies):
        rows.write.mode("append").parquet(path)
    return path, rows.schema


def _stream(t, copies: int = 1):
    path, schema = _landed(t, copies)
    return jobs.snapshot_stream(t.spark, path, schema, files_per_trigger=4)


@query("stream_snapshots", "SELECT * FROM stats")
def _(t):
    out = fresh_path(t.spark, "snapshots")
    jobs.land_snapshots(_stream(t, copies=2), out, fresh_path(t.spark, "state")).awaitTermination()
    return t.spark.read.parquet(out).drop("date")


@query("stream_late_snapshots", "SELECT * FROM stats")
def _(t):
    out = fresh_path(t.spark, "every_snapshot")
    jobs.land_every_snapshot(_stream(t, copies=2), out, fresh_path(t.spark, "state")).awaitTermination()
    return t.spark.read.parquet(out).drop("date", "batch")


@query(
    "retention_swept",
    "SELECT * FROM stats WHERE CAST(time AS DATE) >= CAST((SELECT max(time) FROM stats) - INTERVAL 20 DAY AS DATE)",
)
def _(t):
    path = fresh_path(t.spark, "retained")
    landing.overwrite_dates(t.stats(), path)
    asof = dt.datetime.fromisoformat(t.stats().agg(F.max("time").cast("string")).first()[0])
    retention.withdraw(t.spark, path, asof, days=20)
    retention.sweep(t.spark, path, asof + dt.timedelta(days=1))
    return landing.read_table(t.spark, path).drop("date")


@query("stream_upsert", "SELECT DISTINCT video_id FROM stats")
def _(t):
    out = fresh_path(t.spark, "upsert")
    stream = _stream(t)
    jobs.upsert_items(stream, out, fresh_path(t.spark, "state"), prefer="time").awaitTermination()
    return jobs.read_batches(t.spark, out, stream.schema).select("video_id")


@query("stream_endpoints", "SELECT * FROM ends")
def _(t):
    out = fresh_path(t.spark, "endpoints")
    jobs.track_endpoints(_stream(t), out, fresh_path(t.spark, "state")).awaitTermination()
    return jobs.current_endpoints(t.spark, out, endpoints(t.stats()).schema)


@query(
    "stream_daily_summary",
    """SELECT CAST(date_trunc('day', time) AS TIMESTAMP) AS window_start, CAST(date_trunc('day', time) AS TIMESTAMP) + INTERVAL 24 HOUR AS window_end, count(*) AS snapshots,
       avg(ln(1 + views)) AS mean_log_views, avg(ln(1 + likes)) AS mean_log_likes, avg(ln(1 + comments)) AS mean_log_comments
FROM stats GROUP BY 1, 2 HAVING window_end <= (SELECT max(time) FROM stats) - INTERVAL 10 MINUTE""",
    doubles="mean_log_views mean_log_likes mean_log_comments",
)
def _(t):
    # One batch holds the whole series: files of a series cut by item are not in time order.
    path, schema = _landed(t)
    stream = jobs.snapshot_stream(t.spark, path, schema)
    out = fresh_path(t.spark, "daily")
    jobs.daily_summary(stream, out, fresh_path(t.spark, "state")).awaitTermination()
    return t.spark.read.parquet(out)


@query(
    "daily_summary",
    """SELECT CAST(date_trunc('day', time) AS TIMESTAMP) AS window_start, CAST(date_trunc('day', time) AS TIMESTAMP) + INTERVAL 24 HOUR AS window_end, count(*) AS snapshots,
       avg(ln(1 + views)) AS mean_log_views, avg(ln(1 + likes)) AS mean_log_likes, avg(ln(1 + comments)) AS mean_log_comments
FROM stats GROUP BY 1, 2""",
    doubles="mean_log_views mean_log_likes mean_log_comments",
)
def _(t):
    return jobs.summary_of_windows(t.stats())
