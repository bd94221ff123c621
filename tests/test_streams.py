"""Streams give what the batch operators give, whatever the batches and however often they run."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from countertide.operators.history import endpoints
from countertide.plans.shared import fresh_path
from countertide.sources import landing, retention
from countertide.streaming import jobs

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "video_id string, time timestamp, views long, likes long, comments long"


@pytest.fixture(scope="module")
def landed(spark):
    """Snapshots in several files, in no order of time, with every third row landed twice."""
    rng = random.Random(1)
    rows = [(f"v{rng.randrange(5) if rng.random() < 0.5 else 0}", T0 + dt.timedelta(minutes=i * 17), i, i // 2, i // 3) for i in range(400)]
    path = fresh_path(spark, "t-landed")
    shuffled = rows + rows[::3]
    rng.shuffle(shuffled)
    for part in range(4):
        spark.createDataFrame(shuffled[part::4], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path, spark.createDataFrame(rows, SCHEMA)


def source(spark, landed):
    return jobs.snapshot_stream(spark, landed[0], landed[1].schema, files_per_trigger=1)


def rows_of(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()))


def test_each_snapshot_lands_once(spark, landed):
    out, state = fresh_path(spark, "t-out"), fresh_path(spark, "t-state")
    for _ in range(2):  # the second run finds nothing new
        jobs.land_snapshots(source(spark, landed), out, state).awaitTermination()
    stored = spark.read.parquet(out)
    cols = landed[1].columns
    assert rows_of(stored, cols) == rows_of(landed[1], cols) and "date" in stored.columns


def test_rows_land_once_however_late(spark):
    path, out, state = (fresh_path(spark, f"t-{x}") for x in ("late-in", "late-out", "late-state"))
    day = dt.timedelta(days=1)
    batches = [
        [("a", T0, 1, 1, 1), ("b", T0 + 100 * day, 2, 2, 2), ("b", T0 + 100 * day, 1, 9, 9)],
        [("a", T0, 7, 7, 7), ("a", T0 + 10 * day, 3, 3, 3), (None, T0 + 10 * day, 4, 4, 4), ("c", None, 5, 5, 5)],
        [("a", T0 + 10 * day, 8, 8, 8), (None, T0 + 10 * day, 4, 4, 4), ("c", None, 5, 5, 5), ("d", T0, 6, 6, 6)],
    ]
    for rows in batches:  # each run of the stream finds one new file
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        stream = jobs.snapshot_stream(spark, path, spark.createDataFrame([], SCHEMA).schema)
        jobs.land_every_snapshot(stream, out, state).awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(out).select("video_id", "time", "views").collect()}
    want = {("a", T0, 1), ("b", T0 + 100 * day, 1), ("a", T0 + 10 * day, 3), (None, T0 + 10 * day, 4), ("c", None, 5), ("d", T0, 6)}
    assert got == want and spark.read.parquet(out).count() == len(want)
    # Without the stream's memory all is one batch with the number 0: it overwrites its own folders, and is compared with none.
    jobs.land_every_snapshot(stream, out, fresh_path(spark, "t-again")).awaitTermination()
    first = spark.read.parquet(out).filter("batch = 0")
    assert first.count() == first.select("video_id", "time").distinct().count() == len(want)


def test_expired_dates_are_withdrawn_then_deleted(spark, tmp_path):
    path, day = str(tmp_path / "series"), dt.timedelta(days=1)
    rows = [(f"v{k % 3}", T0 + k * day / 2, k, k, k) for k in range(40)] + [("w", None, 0, 0, 0)]
    landing.append_stats(spark.createDataFrame(rows, SCHEMA), path)
    old = landing.read_table(spark, path)  # a reader that has listed its files
    assert retention.sweep(spark, path, T0 + 99 * day) == [] and retention.read_kept(spark, path).count() == 41
    asof = T0 + 15 * day + dt.timedelta(hours=5)
    for _ in range(2):
        assert retention.withdraw(spark, path, asof, days=5) == (T0 + 10 * day).date()
    retention.withdraw(spark, path, asof + dt.timedelta(hours=1), days=9)  # a longer retention brings nothing back
    kept = retention.read_kept(spark, path)
    assert "PartitionFilters: [(isnull(date" in kept._jdf.queryExecution().toString()
    assert kept.count() == 21 and kept.agg(F.min("time")).first()[0] == T0 + 10 * day
    assert retention.sweep(spark, path, asof + dt.timedelta(hours=23)) == [] and old.count() == 41
    assert retention.sweep(spark, path, asof + day) == [(T0 + k * day).date() for k in range(10)]
    assert not [p for p in (tmp_path / "series").glob("date=2024-01-0*")] + [p for p in (tmp_path / "series").glob("date=2024-01-10")]
    assert retention.sweep(spark, path, asof + day) == [] and landing.read_table(spark, path).count() == 21
    landing.append_stats(spark.createDataFrame([("late", T0, 1, 1, 1)], SCHEMA), path)
    assert retention.read_kept(spark, path).count() == 21 and retention.sweep(spark, path, asof + day) == [T0.date()]
    assert retention.withdrawals(spark, str(tmp_path / "none")) == [] and retention.sweep(spark, str(tmp_path / "none"), asof) == []


def test_first_write_wins_across_batches(spark, landed):
    out = fresh_path(spark, "t-out")
    stream = source(spark, landed)
    jobs.upsert_items(stream, out, fresh_path(spark, "t-state"), prefer="time").awaitTermination()
    stored = jobs.read_batches(spark, out, stream.schema)
    assert stored.count() == stored.select("video_id").distinct().count() == landed[1].select("video_id").distinct().count()
    # A row in the first batch is never replaced by a later one.
    first_batch = stored.groupBy("video_id").agg(F.min("batch")).filter("`min(batch)` > 0").count()
    assert first_batch <= 4


def test_running_endpoints(spark, landed):
    out = fresh_path(spark, "t-out")
    path = fresh_path(spark, "t-once")
    landed[1].repartition(4).write.parquet(path)
    stream = jobs.snapshot_stream(spark, path, landed[1].schema, files_per_trigger=1)
    jobs.track_endpoints(stream, out, fresh_path(spark, "t-state")).awaitTermination()
    want = endpoints(landed[1])
    got = jobs.current_endpoints(spark, out, want.schema)
    assert rows_of(got, want.columns) == rows_of(want, want.columns)


def test_endpoint_versions_are_merged(spark):
    path, out, state = (fresh_path(spark, f"t-{x}") for x in ("ends-in", "ends-out", "ends-state"))
    rows = [(f"v{k % 4}", T0 + dt.timedelta(hours=k), k, k, k) for k in range(30)]
    for part in range(10):
        spark.createDataFrame(rows[part * 3 : part * 3 + 3], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    stream = jobs.snapshot_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
    jobs.track_endpoints(stream, out, state, fan=3).awaitTermination()
    want = endpoints(spark.createDataFrame(rows, SCHEMA))
    stored = jobs._stored_runs(spark, out)
    assert {(a, b) for a, b in stored if a < b} == {(0, 2), (3, 5), (6, 8), (0, 8)}
    assert jobs._covering(stored) == [(0, 8), (9, 9)]
    assert rows_of(jobs.current_endpoints(spark, out, want.schema), want.columns) == rows_of(want, want.columns)
    assert jobs.drop_merged(spark, out, before=6) == 6  # what lies in 0-2 and 3-5
    assert rows_of(jobs.current_endpoints(spark, out, want.schema), want.columns) == rows_of(want, want.columns)
    assert jobs.drop_merged(spark, out, before=10) == 6 and jobs.drop_merged(spark, out, before=10) == 0
    assert sorted(jobs._stored_runs(spark, out)) == [(0, 8), (9, 9)]
    assert rows_of(jobs.current_endpoints(spark, out, want.schema), want.columns) == rows_of(want, want.columns)
    with pytest.raises(ValueError, match="batch 1 is not stored"):
        jobs._covering([(0, 0), (2, 2)])


def test_daily_summary(spark, landed):
    path = fresh_path(spark, "t-whole")
    landed[1].coalesce(1).write.parquet(path)
    out = fresh_path(spark, "t-out")
    jobs.daily_summary(jobs.snapshot_stream(spark, path, landed[1].schema), out, fresh_path(spark, "t-state")).awaitTermination()
    last = landed[1].agg(F.max("time")).first()[0] - dt.timedelta(minutes=10)
    want = jobs.summary_of_windows(landed[1]).filter(F.col("window_end") <= F.lit(last))
    got, expected = rows_of(spark.read.parquet(out), want.columns), rows_of(want, want.columns)
    assert [r[:3] for r in got] == [r[:3] for r in expected] and len(got) == 4
    assert [x for r in got for x in r[3:]] == pytest.approx([x for r in expected for x in r[3:]])


def test_naive_times_are_cast(spark):
    path = fresh_path(spark, "t-naive")
    naive = spark.createDataFrame([("v", T0)], "video_id string, time timestamp_ntz")
    naive.write.parquet(path)
    stream = jobs.snapshot_stream(spark, path, naive.schema)
    assert dict(stream.dtypes)["time"] == "timestamp"
