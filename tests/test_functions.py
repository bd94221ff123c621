"""Exact values of single functions on small frames."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from countertide.functions import calendar, numeric, text
from countertide.operators import features, history, select


def one(df):
    return df.first()


def test_clean_numeric_replaces_nonfinite(spark):
    df = spark.createDataFrame([(1.0, 1), (float("inf"), None), (float("nan"), 3)], "a double, b int")
    rows = select.clean_numeric(df).collect()
    assert [r.a for r in rows] == [1.0, 0.0, 0.0]
    assert [r.b for r in rows] == [1, 0, 3]


def test_engagement_ratios(spark):
    df = spark.createDataFrame([(100, 10, 5), (0, 0, 0), (50, 5, 1)], "views long, likes long, comments long")
    rows = features.add_engagement(df).collect()
    assert rows[0].like_view_ratio == 0.1
    assert rows[1].like_view_ratio == 0
    assert rows[0].engagement_score == 0.2


def test_dates(spark):
    df = spark.createDataFrame([("2023-10-27 10:00:00",), ("2023-10-28 14:00:00",)], "p string")
    df = df.select(F.col("p").cast("timestamp").alias("published_at"))
    rows = features.add_date_features(df).collect()
    assert rows[0].publish_day == 4 and rows[0].is_weekend == 0
    assert rows[1].is_weekend == 1
    assert rows[0].hour_sin == pytest.approx(math.sin(2 * math.pi * 10 / 24))


DIRTY = "Check out my Minecraft   video! http://link.com #gaming"


def test_clean_text(spark):
    df = spark.createDataFrame([(DIRTY,), (None,)], "t string")
    rows = df.select(text.clean_text(F.col("t")).alias("c")).collect()
    assert [r.c for r in rows] == ["check out my minecraft video gaming", ""]


def test_corpus(spark):
    df = spark.createDataFrame([("Video 1", DIRTY), (None, None)], "title string, tags string")
    rows = df.select(text.corpus(["title", "tags"]).alias("c")).collect()
    assert "minecraft" in rows[0].c and "video 1" in rows[0].c
    assert rows[1].c == ""


def test_tag_list(spark):
    df = spark.createDataFrame([("Minecraft, Gaming,  Tutorial ",), (None,), (" ,,",), ("a,\tA",)], "t string")
    rows = df.select(text.tag_list(F.col("t")).alias("c")).collect()
    assert [r.c for r in rows] == [["minecraft", "gaming", "tutorial"], [], [], ["a", "a"]]


def test_title_features(spark):
    df = spark.createDataFrame([("WOW! É 3 Ⅷ?!",), (None,), ("👍a",)], "title string")
    a, b, c = features.add_title_features(df).collect()
    assert (a.title_len, a.caps_count, a.exclamation_count, a.question_count, a.has_digits) == (12, 5, 2, 1, 1)
    assert a.caps_ratio == 5 / 13
    assert (b.title_len, b.caps_ratio, b.has_digits) == (0, 0.0, 0)
    assert c.title_len == 2


@pytest.mark.parametrize(
    "spelled, seconds",
    [
        ("PT1H2M3S", 3723),
        ("P1DT1S", 86401),
        ("P2W", 1209600),
        ("PT1.9S", 1),
        ("PT0,5M", 30),
        ("-PT10S", -10),
        ("PT0S", 0),
        ("P1Y", 0),
        ("P1M", 0),
        ("1H", 0),
        ("PT", 0),
        (None, 0),
    ],
)
def test_duration(spark, spelled, seconds):
    df = spark.createDataFrame([(spelled,)], "s string")
    assert one(df.select(calendar.duration_seconds(F.col("s")).alias("n"))).n == seconds


@pytest.mark.parametrize(
    "url, found",
    [
        ("dQw4w9WgXcQ", "dQw4w9WgXcQ"),
        ("https://www.youtube.com/watch?v=dQw4w9WgXcQ&t=3", "dQw4w9WgXcQ"),
        ("https://youtu.be/dQw4w9WgXcQ", "dQw4w9WgXcQ"),
        ("https://www.youtube.com/embed/dQw4w9WgXcQ", "dQw4w9WgXcQ"),
        ("dQw4w9 gXcQ", None),
        ("nothing", None),
        (None, None),
    ],
)
def test_video_id(spark, url, found):
    df = spark.createDataFrame([(url,)], "u string")
    assert one(df.select(text.video_id_of(F.col("u")).alias("v"))).v == found


def test_video_link(spark):
    df = spark.createDataFrame([("dQw4w9WgXcQ",)], "v string")
    assert one(df.select(text.video_link(F.col("v")).alias("l"))).l.endswith("watch?v=dQw4w9WgXcQ")


def test_genre_rules(spark):
    df = spark.createDataFrame([("Minecraft,music",), ("Music",), ("hi-tech",), ("education",), (None,)], "t string")
    rows = df.select(text.gaming_or_default(F.col("t")).alias("a"), text.keyword_genre(F.col("t")).alias("b")).collect()
    assert [r.a for r in rows] == ["Gaming", "Vlog", "Vlog", "Vlog", "Vlog"]
    assert [r.b for r in rows] == ["Gaming", "Music", "Tech", "Education", "Vlog"]


def test_display_number_rounds_like_python(spark):
    def spelled(n):
        if n >= 1_000_000:
            return f"{n / 1_000_000:.1f}M"
        return f"{n / 1_000:.1f}K" if n >= 1_000 else str(int(n))

    values = list(range(-5, 12000)) + [10**6 * k + 50000 * j for k in range(1, 60) for j in range(20)] + [10**12 + 7]
    df = spark.createDataFrame([(v,) for v in values], "n long").select("n", numeric.display_number(F.col("n")).alias("s"))
    assert all(r.s == spelled(r.n) for r in df.collect())


def test_bounded_log(spark):
    df = spark.createDataFrame([(-3.0,), (1.0,), (99.0,)], "x double")
    rows = df.select(numeric.from_bounded_log(F.col("x")).alias("y")).collect()
    assert [r.y for r in rows] == pytest.approx([0.0, math.expm1(1), math.expm1(25)])


def test_truthy(spark):
    df = spark.createDataFrame([("True",), ("1",), ("YES",), ("no",), (None,)], "x string")
    assert [r.y for r in df.select(text.truthy(F.col("x")).alias("y")).collect()] == [True, True, True, False, False]


def test_channel_history(spark):
    days = [dt.datetime(2023, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame(
        [("v1", "c1", days[0], 100), ("v2", "c1", days[1], 200), ("v3", "c1", days[2], 300)],
        "video_id string, channel_id string, published_at timestamp, views long",
    )
    rows = history.channel_recent_avg(df, window=2).orderBy("published_at").collect()
    assert [r.channel_avg_views_recent for r in rows] == [0, 100, 150]
    assert history.channel_recent_avg(df.drop("channel_id")).columns == ["video_id", "published_at", "views"]


def test_clickbait_labels(spark):
    df = spark.createDataFrame(
        [
            ("v1", "Clickbait Title", 20000, 10, 1, 60, dt.datetime(2023, 1, 1)),
            ("v2", "Normal Title", 500, 50, 10, 120, dt.datetime(2023, 1, 2)),
        ],
        "video_id string, title string, views long, likes long, comments long, duration_seconds int, published_at timestamp",
    )
    out = features.clickbait_features(df, engagement_threshold=0.05, min_views=1000)
    assert {(r.title_len, r.is_clickbait) for r in out.collect()} == {(15, 1), (12, 0)}
    assert out.columns == [*features.CLICKBAIT_FEATURES, "is_clickbait"]


def test_features_skip_absent_inputs(spark):
    df = spark.createDataFrame([(1,)], "x int")
    for add in (features.add_growth, features.add_logs, features.add_date_features, features.add_title_features, features.add_video_age):
        assert add(df).columns == ["x"]


def test_rank_velocity_and_outcome(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("v1", r, start + dt.timedelta(hours=h)) for h, r in enumerate([50, 40, 30, 20, 10])]
    rows += [("v2", 100, start + dt.timedelta(hours=h)) for h in range(5)] + [("v3", 3, start)]
    df = spark.createDataFrame(rows, "video_id string, rank int, discovered_at timestamp")
    got = {r.video_id: r for r in history.trending_outcome(df).collect()}
    assert got["v1"].rank_velocity == -8.0 and got["v1"].is_viral == 1
    assert got["v2"].rank_velocity == 0 and got["v2"].is_viral == 0
    assert got["v3"].rank_velocity == 0 and got["v3"].is_viral == 1


def test_quarantine(spark):
    df = spark.createDataFrame(
        [(1, -1, 10, [1]), (2, 5, 0, []), (3, 5, 10, [0, 2]), (4, 5, 10, [1, 2])],
        "id int, views long, duration_seconds int, ranks array<int>",
    )
    good, bad = select.quarantine_invalid(df, ranks="ranks")
    assert [r.id for r in good.collect()] == [4]
    assert {r.id: r.errors for r in bad.collect()} == {
        1: ["negative_views"],
        2: ["nonpositive_duration", "empty_ranks"],
        3: ["rank_below_one"],
    }


def test_freshness_gate(spark):
    now = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(now - dt.timedelta(hours=h),) for h in (1, 2, 3)] + [(None,)], "published_at timestamp")
    rows = features.freshness_gate(df, now).collect()
    assert [r.scorable for r in rows] == [True, True, False, False]
    assert [r.reason for r in rows] == [None, None, "too_old", "no_publish_time"]


def test_flatten_structs(spark):
    df = spark.sql("select named_struct('a', 1, 'b', named_struct('c', 'x')) as s, '2024-01-01T00:00:00Z' as timestamp")
    flat = select.flatten_structs(df)
    assert flat.columns == ["s.a", "s.b.c", "timestamp"]
    assert flat.first()["timestamp"] == dt.datetime(2024, 1, 1)


def test_link_ends_at_any_space(spark):
    row = spark.createDataFrame([("see http://a.b/c\u00a0here",)], "x string").select(text.clean_text(F.col("x")).alias("y")).first()
    assert row.y.replace("\u00a0", " ").split() == ["see", "here"]


def test_stop_words_are_those_of_spark(spark):
    from pyspark.ml.feature import StopWordsRemover

    from countertide.functions.stopwords import ENGLISH_STOP_WORDS
    from countertide.functions.text import clean_text

    words = spark.createDataFrame([(w,) for w in StopWordsRemover.loadDefaultStopWords("english")], "w string")
    cleaned = words.select(F.explode(F.split(clean_text(F.col("w")), " "))).distinct().collect()
    assert sorted(r[0] for r in cleaned) == ENGLISH_STOP_WORDS
