"""Operators on small frames: joins, metrics, gates, rules and integrity, against hand or brute-force results."""

from __future__ import annotations

import datetime as dt
import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from countertide.operators import features, gates, history, ingest, integrity, metrics, pairs, rules, select, stats
from countertide.plans.shared import fresh_path
from countertide.sources import landing

T0 = dt.datetime(2024, 1, 1)


def hours(h: float) -> dt.datetime:
    return T0 + dt.timedelta(hours=h)


@pytest.fixture(scope="module")
def videos(spark):
    return spark.createDataFrame(
        [(f"v{i}", f"Title {i}", "a,b", 60 * i, hours(-i), "c", "10") for i in range(1, 6)],
        "video_id string, title string, tags string, duration_seconds int, published_at timestamp, channel_id string, category_id string",
    )


@pytest.fixture(scope="module")
def series(spark):
    rows = [("v1", h, 100 * (h + 1), 10 * h, h) for h in range(6)]
    rows += [("v2", 0, 5, 1, 0), ("v2", 3, 8, 1, 0)]
    rows += [("v3", 0, 50, 1, 0), ("v3", 2, 60, 1, 0)]  # exactly two hours: not strictly more
    rows += [("v4", 1, 70, 0, 0), ("v9", 0, 1, 1, 1), ("v9", 9, 9, 9, 9)]
    return spark.createDataFrame(
        [(v, hours(h), a, b, c) for v, h, a, b, c in rows],
        "video_id string, time timestamp, views long, likes long, comments long",
    )


@pytest.fixture(scope="module")
def discovery(spark):
    rows = [("v1", "q", hours(2)), ("v1", "r", hours(1)), ("v2", "q", hours(5)), ("v3", "q", hours(0)), ("v9", "q", hours(0))]
    return spark.createDataFrame(rows, "video_id string, query string, discovered_at timestamp")


def test_velocity_pairs(videos, series, discovery):
    rows = pairs.velocity_pairs(videos, series, discovery).collect()
    assert [r.video_id for r in rows] == ["v2", "v1"]
    first = rows[1]
    assert (first.start_views, first.target_views, first.end_likes, first.hours_tracked) == (100, 600, 50, 5.0)
    assert first.first_discovered == hours(1)


def test_fallback_and_failure(videos, series, discovery):
    strict = pairs.velocity_pairs_or_fallback(videos, series, discovery)
    assert "hours_tracked" in strict.columns
    loose = pairs.velocity_pairs_or_fallback(videos, series, discovery, min_hours=1000)
    assert {r.video_id for r in loose.collect()} == {"v1", "v2", "v3"} and "start_time" in loose.columns
    with pytest.raises(ValueError):
        pairs.velocity_pairs_or_fallback(videos, series.filter("video_id = 'v4'"), discovery)


def test_target_window_is_inclusive(spark, videos, series):
    # Published at -1 h; the window [2, 6] h after that is [1, 5] h: the last snapshot, at 5 h, is inside.
    got = {r.video_id: r for r in pairs.target_window_pairs(videos, series, target_hours=4, window_hours=2).collect()}
    assert got["v1"].target_views == 600 and got["v1"].start_views == 100
    narrow = {r.video_id: r for r in pairs.target_window_pairs(videos, series, target_hours=4, window_hours=1).collect()}
    assert narrow["v1"].target_views == 500


def test_latest_and_earliest(series):
    latest = {r.video_id: r.views for r in history.latest_per_key(series).collect()}
    assert latest == {"v1": 600, "v2": 8, "v3": 60, "v4": 70, "v9": 9}
    first = {r.video_id: r.views for r in history.earliest_per_key(series).collect()}
    assert first["v1"] == 100 and first["v4"] == 70


def test_viral_features_two_ways(videos, series, discovery):
    a = features.viral_features(features.viral_endpoints(pairs.viral_series(videos, series, discovery)))
    b = features.viral_features(features.viral_endpoints_from_tables(videos, series, discovery))
    cols = sorted(a.columns)
    rows = sorted(map(tuple, a.select(cols).collect()))
    assert rows == sorted(map(tuple, b.select(cols).collect())) and len(rows) == 3
    viral = {r.video_id for r in a.collect() if r.is_viral}
    assert viral == {"v1"}
    assert len(features.viral_training_matrix(a, keep=()).columns) == 18
    with pytest.raises(ValueError):
        features.viral_features(features.viral_endpoints_from_tables(videos, series.filter("video_id = 'v4'"), discovery))


def test_velocity_features(spark, videos, series, discovery):
    out = features.velocity_features(pairs.velocity_pairs(videos, series, discovery))
    assert out.columns == ["video_id", *features.VELOCITY_FEATURES, "views"]
    row = out.filter("video_id = 'v1'").first()
    assert row.video_age_hours == 1.0 and row.category_id == 10 and row.views == 600
    assert row.initial_virality_slope == pytest.approx(math.log(101) / math.log(2))


def test_due_followups(spark):
    seen = [(h, hours(-h / 60)) for h in (24 * 60, 24 * 60 + 90, 24 * 60 + 91, 22 * 60 + 30, 22 * 60 + 29, 48 * 60, 168 * 60)]
    df = spark.createDataFrame([(str(m), t) for m, t in seen], "video_id string, first_seen_at timestamp")
    due = {int(r.video_id) for r in select.due_followups(df, T0).collect()}
    assert due == {24 * 60, 24 * 60 + 90, 22 * 60 + 30, 48 * 60, 168 * 60}


def test_min_baseline_filters_before_clipping(spark):
    df = spark.createDataFrame([(9, 100), (10, -5), (50, 60)], "start_views long, target_views long")
    assert [tuple(r) for r in select.min_baseline(df).collect()] == [(10, 0), (50, 60)]


def test_top_percentile_and_tags(spark):
    df = spark.createDataFrame([(v, "tag", "title") for v in range(10, 101, 10)], "views long, tags string, title string")
    top = select.top_percentile(df, "views", 0.90)
    assert [r.views for r in top.collect()] == [100]
    with pytest.raises(ValueError):
        select.nonempty_tags(top, min_rows=10)
    assert select.nonempty_tags(df).count() == 10


def test_hash_sample_is_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "video_id")
    a = select.hash_ordered_sample(df, F.col("video_id").cast("string"), 50)
    b = select.hash_ordered_sample(df.repartition(13), F.col("video_id").cast("string"), 50)
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() == 50


# ---------------------------------------------------------------- metrics


def weighted(y, p):
    labels = sorted(set(y) | set(p))
    out = dict.fromkeys(("precision", "recall", "f1"), 0.0)
    for c in labels:
        tp = sum(a == b == c for a, b in zip(y, p))
        support, guessed = y.count(c), p.count(c)
        out["precision"] += support * (tp / guessed if guessed else 0) / len(y)
        out["recall"] += support * (tp / support if support else 0) / len(y)
        out["f1"] += support * (2 * tp / (support + guessed)) / len(y)
    return out


def test_multiclass_metrics(spark):
    rng = random.Random(5)
    y = [rng.choice("abc") for _ in range(200)]
    p = [rng.choice("abcd") for _ in range(200)]
    got = metrics.classification_metrics(spark.createDataFrame(list(zip(y, p)), "y string, p string"), "y", "p").first()
    want = weighted(y, p)
    assert got.accuracy == pytest.approx(sum(a == b for a, b in zip(y, p)) / 200) == pytest.approx(got.recall)
    assert (got.precision, got.f1) == pytest.approx((want["precision"], want["f1"]))


def test_binary_metrics(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 0.0), (0, 1.0), (0, 0.0), (1, 1.0)], "y int, p double")
    got = metrics.classification_metrics(df, "y", "p").first()
    assert tuple(got) == pytest.approx((0.6, 2 / 3, 2 / 3, 2 / 3))
    none = metrics.classification_metrics(df.withColumn("p", F.lit(0)), "y", "p").first()
    assert (none.precision, none.recall, none.f1) == (0, 0, 0)


def test_evaluate_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0, 0.5), (2, 1.5), (1, 0.51)], "y int, p double")
    assert metrics.evaluate_classification(df, "y", "p").first().accuracy == 1.0


def test_regression_metrics(spark):
    y, p = np.array([0.0, 2.0, 4.0, 8.0]), np.array([1.0, 2.0, 3.0, 10.0])
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    got = metrics.regression_metrics(df, "y", "p").first()
    assert got.mae == 1.0 and got.rmse == pytest.approx(math.sqrt(1.5))
    assert got.r2 == pytest.approx(1 - 6 / ((y - y.mean()) ** 2).sum())
    assert got.mape_percent == pytest.approx(100 * (1 + 0 + 0.25 + 0.25) / 4)
    assert metrics.masked_mape(df, "y", "p").first().mape == pytest.approx(100 * (0.25 + 0.25) / 3)
    same = metrics.regression_metrics(df.withColumn("y", F.lit(3.0)).withColumn("p", F.lit(3.0)), "y", "p").first()
    assert same.r2 == 1.0


def test_topk_and_confusion(spark):
    df = spark.createDataFrame([(0, [0.5, 0.3, 0.2]), (0, [0.1, 0.1, 0.8]), (1, [0.3, 0.3, 0.4])], "y int, p array<double>")
    assert metrics.topk_accuracy(df, "y", "p", k=2).first()[0] == pytest.approx(2 / 3)
    cells = metrics.confusion_matrix(spark.createDataFrame([(1, 1), (1, 1)], "y int, p int"), "y", "p").collect()
    assert {(c.actual, c.predicted): c.n for c in cells} == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}


def test_rule_metrics_of_nothing(spark):
    empty = spark.createDataFrame([], "lift double, confidence double")
    assert tuple(metrics.rule_metrics(empty).first()) == (0, 0.0, 0.0, 0.0)


def test_class_balance_without_positives(spark):
    assert metrics.class_balance(spark.createDataFrame([(0,)], "y int"), "y").first().scale_pos_weight == 1.0


def test_histogram_keeps_empty_bins_and_the_top(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (10.0,), (10.0,), (None,)], "x double")
    rows = stats.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r.n for r in rows] == [2, 0, 0, 0, 2]
    flat = stats.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 4).orderBy("bin").collect()
    assert [r.n for r in flat] == [2, 0, 0, 0]


def test_correlation_is_pairwise_complete(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, 4, None], "b": [2.0, 1, 4, None, 9], "c": [5.0] * 5})
    df = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in pdf.values.tolist()], "a double, b double, c double")
    got = {(r.a, r.b): r["corr"] for r in stats.correlation_matrix(df, ["a", "b", "c"]).collect()}
    want = pdf.corr()
    assert len(got) == 9 and got["a", "b"] == pytest.approx(want.loc["a", "b"]) == pytest.approx(got["b", "a"])
    assert got["a", "c"] is None and got["a", "a"] == pytest.approx(1)


def test_ols_needs_three_rows(spark):
    two = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "x double, y double")
    assert stats.ols_trend(two, "y", "x").first().slope is None
    three = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 7.0)], "x double, y double")
    assert stats.ols_trend(three, "y", "x").first().slope == pytest.approx(2)
    constant = spark.createDataFrame([(1.0, 3.0), (1.0, 5.0), (1.0, 7.0)], "x double, y double")
    assert stats.ols_trend(constant, "y", "x").first().slope is None


# ---------------------------------------------------------------- gates and integrity


@pytest.mark.parametrize(
    "metric, new, old, gain, promoted",
    [("f1", 0.8, 0.7, 0.0, True), ("f1", 0.7, 0.7, 0.0, True), ("f1", 0.7, 0.7, 0.01, False), ("rmse", 1.0, 2.0, 0.5, True), ("mae", 2.0, 1.0, 0.0, False), ("r2", 0.1, None, 0.5, True)],
)
def test_champion_gate(spark, metric, new, old, gain, promoted):
    challenger = spark.createDataFrame([(new,)], f"{metric} double")
    champion = spark.createDataFrame([(old,)], f"{metric} double") if old is not None else None
    assert gates.champion_gate(challenger, champion, metric, gain).first().promoted is promoted


def test_bounds_gate(spark):
    m = spark.createDataFrame([(5, 1.05)], "rule_count int, avg_lift double")
    assert gates.bounds_gate(m, gates.RULE_BOUNDS).first().promoted
    assert not gates.bounds_gate(m.withColumn("rule_count", F.lit(4)), gates.RULE_BOUNDS).first().promoted
    assert gates.bounds_gate(m, gates.ANOMALY_BOUNDS).first().promoted  # a missing metric is skipped


def test_integrity_report(spark):
    rows = [(i, i % 2, 1, None if i < 10 else i, i % 2) for i in range(60)] + [(5, 1, 1, None, 1), (5, 1, 1, None, 0)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, y int")
    got = {(r.check, r.column): r for r in integrity.integrity_report(df, label="y").collect()}
    assert got["rows", "*"].value == 62 and got["rows", "*"].passed
    assert not got["null_share", "d"].passed and got["null_share", "a"].passed
    assert not got["constant", "c"].passed
    assert got["duplicate_share", "*"].value == pytest.approx(1 / 62)
    assert got["conflict_share", "y"].value == pytest.approx(3 / 62) and not got["conflict_share", "y"].passed
    assert not got["correlation", "a~d"].passed
    few = integrity.integrity_report(df.limit(5), label="y").collect()
    assert all(r.passed for r in few if r.check != "rows")


# ---------------------------------------------------------------- rules


def brute_rules(baskets, min_support, min_lift, min_confidence):
    n = len(baskets)
    items = sorted(set().union(*baskets))
    support = {}
    for k in range(1, len(items) + 1):
        for s in itertools.combinations(items, k):
            c = sum(set(s) <= b for b in baskets)
            if c and c / n >= min_support:
                support[s] = c / n
    found = {}
    for s in support:
        for k in range(1, len(s)):
            for a in itertools.combinations(s, k):
                c = tuple(x for x in s if x not in a)
                confidence = support[s] / support[a]
                lift = confidence / support[c]
                if confidence > min_confidence and lift >= min_lift:
                    found[a, c] = (confidence, lift)
    return support, found


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    baskets = [set(rng.sample("abcdefgh", rng.randrange(2, 6))) for _ in range(60)]
    baskets += [set("abc")] * 30  # a third of all baskets are copies
    df = spark.createDataFrame([(i, sorted(b)) for i, b in enumerate(baskets)], "video_id int, items array<string>")
    itemsets = rules.frequent_itemsets(df, min_support=0.05)
    support, found = brute_rules(baskets, 0.05, 1.05, 0.4)
    assert {tuple(r["items"]): pytest.approx(r.support) for r in itemsets.collect()} == support
    got = {(tuple(r.antecedents), tuple(r.consequents)): (r.confidence, r.lift) for r in rules.association_rules(itemsets, 1.05, 0.4).collect()}
    assert set(got) == set(found)
    assert any(len(c) > 1 for _, c in got)
    for k in got:
        assert got[k] == pytest.approx(found[k])


def test_relaxed_support(spark):
    df = spark.createDataFrame([(["a", "b"],), (["c", "d"],)], "items array<string>")
    assert rules.frequent_itemsets(df, min_support=0.9, relaxed_support=0.5).count() == 6
    with pytest.raises(ValueError):
        rules.frequent_itemsets(df, min_support=0.9, relaxed_support=0.8)
    with pytest.raises(ValueError):
        rules.frequent_itemsets(df.limit(0))


def test_transactions(spark):
    df = spark.createDataFrame(
        [("1", "python, coding, tutorial"), ("2", "python, machine learning"), ("3", "a, A"), ("4", "solo"), ("5", None), ("6", "")],
        "video_id string, tags string",
    )
    got = {r.video_id: r["items"] for r in features.tag_transactions(df).collect()}
    assert got == {"1": ["python", "coding", "tutorial"], "2": ["python", "machine learning"], "3": ["a"]}


def test_recommendations(spark):
    table = spark.createDataFrame(
        [(["minecraft", "speedrun"], ["dream"]), (["minecraft", "speedrun"], ["manhunt"]), (["vlog"], ["lifestyle"])],
        "antecedents array<string>, consequents array<string>",
    )
    df = spark.createDataFrame(
        [(1, ["Minecraft", "SPEEDRUN", "dream"]), (2, ["minecraft"]), (3, ["vlog", "minecraft", "speedrun"]), (4, []), (5, None)],
        "video_id int, tags array<string>",
    )
    got = {r.video_id: r.recommended for r in rules.recommend_tags(table, df).collect()}
    fallback = list(rules.FALLBACK_TAGS)
    assert got == {1: ["dream", "manhunt"], 2: fallback, 3: ["dream", "lifestyle", "manhunt"], 4: fallback, 5: fallback}


# ---------------------------------------------------------------- ingest


RAW = """
{"id":"a","statistics":{"viewCount":"12","likeCount":"x"},"snippet":{"title":"T","description":"D","tags":["p","q,r"],"publishedAt":"2024-01-02T03:04:05Z","channelId":"c","categoryId":"20","thumbnails":{"high":{"url":"u"}}},"contentDetails":{"duration":"PT1M","definition":"hd"},"status":{"madeForKids":true}}
{"id":"b"}
"""


def test_ingest_from_json(spark, tmp_path):
    (tmp_path / "items.json").write_text(RAW.strip())
    raw = landing.read_raw_items(spark, str(tmp_path))
    got = {r.video_id: r for r in ingest.ingest_video_items(raw).collect()}
    assert got["a"].tags == "p,q,r" and got["a"].duration_seconds == 60 and got["a"].made_for_kids
    assert got["a"].published_at == dt.datetime(2024, 1, 2, 3, 4, 5) and got["a"].thumbnail_url == "u"
    assert (got["b"].title, got["b"].description, got["b"].tags, got["b"].duration_seconds) == ("", "", "", 0)
    counters = {r.video_id: (r.views, r.likes, r.comments) for r in ingest.ingest_stat_snapshot(raw, T0).collect()}
    assert counters == {"a": (12, 0, 0), "b": (0, 0, 0)}


def test_descriptions_are_cut(spark):
    raw = spark.createDataFrame([("x" * 3000,)], "d string").select(
        F.lit("a").alias("id"), F.from_json(F.to_json(F.struct(F.struct(F.col("d").alias("description")).alias("snippet"))), "snippet struct<title string, description string, tags array<string>, publishedAt string, channelId string, categoryId string, defaultAudioLanguage string, thumbnails struct<high struct<url string>>>, contentDetails struct<duration string, definition string>, status struct<madeForKids boolean>").alias("r")
    ).select("id", "r.*")
    assert len(ingest.ingest_video_items(raw).first().description) == 2000


def test_discovery_logs(spark):
    pages = spark.createDataFrame([("q", [(("a",),), (("b",),)]), ("r", [(("a",),)])], "query string, items array<struct<id: struct<videoId: string>>>")
    hits = ingest.ingest_search_hits(pages)
    assert sorted((r.video_id, r.query) for r in hits.collect()) == [("a", "q"), ("a", "r"), ("b", "q")]
    listed = spark.createDataFrame([([("x",), ("y",)],)], "items array<struct<id: string>>")
    trend = ingest.ingest_trending(listed)
    assert [(r.video_id, r["rank"]) for r in trend.collect()] == [("x", 1), ("y", 2)]
    joint = ingest.union_intents(hits, trend).unionByName(spark.createDataFrame([("z", "other")], "video_id string, type string"), allowMissingColumns=True)
    search, trending = ingest.route_intents(joint)
    assert (search.count(), trending.count()) == (3, 2)


def test_first_write_wins(spark):
    target = spark.createDataFrame([("a", 1)], "k string, n int")
    batch = spark.createDataFrame([("a", 9), ("b", 5), ("b", 3)], "k string, n int")
    out = ingest.insert_if_absent(target, batch, ["k"], prefer=F.col("n"))
    assert sorted(map(tuple, out.collect())) == [("a", 1), ("b", 3)]
    again = ingest.insert_if_absent(out, batch, ["k"], prefer=F.col("n"))
    assert sorted(map(tuple, again.collect())) == [("a", 1), ("b", 3)]


def test_partitioned_series(spark, series):
    path = fresh_path(spark, "t-append")
    landing.append_stats(series.unionAll(series), path)
    stored = landing.read_table(spark, path)
    assert stored.count() == series.count()
    kept = ingest.apply_retention(stored, hours(24), days=1)
    plan = kept._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "date" in stored.columns
    assert kept.count() == series.count()
    landing.overwrite_dates(series.filter("video_id = 'v1'"), path)
    assert landing.read_table(spark, path).count() == 6


def test_stored_snapshots_are_not_appended_again(spark, series):
    path = fresh_path(spark, "t-append")
    undated = series.limit(1).withColumn("time", F.lit(None).cast("timestamp"))
    for batch in (series, series, series.limit(0), undated, undated):
        landing.append_stats(batch, path)
    assert landing.read_table(spark, path).count() == series.count() + 1
