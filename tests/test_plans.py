"""The shape of physical plans: what reaches the scan, how often data is shuffled, what stays out."""

from __future__ import annotations

import os
import re

import pytest

from countertide.catalog import REGISTRY
from countertide.operators import history, pairs, select
from countertide.plans.shared import frozen_while
from countertide.sources.bindings import Tables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"Exchange (?:hash|range)partitioning|Exchange RoundRobin", text))


def test_scans_read_only_what_is_used(tables):
    text = plan(history.snapshot_counts(tables.stats()))
    assert "ReadSchema: struct<video_id:bigint>" in text


def test_time_bound_reaches_the_scan(tables):
    text = plan(select.at_or_after(tables.stats(), select.latest_time(tables.stats()), 24))
    assert "GreaterThanOrEqual(time" in text


def test_followups_reach_the_scan(tables):
    text = plan(select.due_followups(tables.videos(), select.latest_time(tables.stats())))
    assert "Or(Or(And(GreaterThanOrEqual(first_seen_at" in text


def test_endpoints_take_one_shuffle_and_hash_aggregation(tables):
    text = plan(history.endpoints(tables.stats()))
    assert shuffles(text) == 1 and "SortAggregate" not in text and "Window" not in text


def test_latest_row_takes_hash_aggregation(tables):
    text = plan(history.latest_per_key(tables.stats()))
    assert shuffles(text) == 1 and "SortAggregate" not in text


def test_pairs_shuffle_each_input_once(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(pairs.velocity_pairs(tables.videos(), tables.stats(), tables.discovery()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Discovery, series and metadata by item, then the final order.
    assert shuffles(text) == 4


@pytest.mark.parametrize("name", ["velocity_features", "clickbait_features", "title_features", "engagement", "tfidf", "association_rules", "ks_statistic"])
def test_no_python_workers(spark, name):
    assert "Python" not in plan(REGISTRY[name](spark, FOLDER))


@pytest.mark.parametrize("name", sorted(REGISTRY.keys() - {n for n in REGISTRY if n.startswith(("train_", "score_", "stream_", "genre_gate", "anomaly_gate", "champion_gate_viral", "velocity_residuals", "feature_importance", "svd", "choose_"))}))
def test_no_cartesian_products_or_unbounded_windows(spark, name):
    text = plan(REGISTRY[name](spark, FOLDER))
    assert "CartesianProduct" not in text
    # A window without partition may only run over one row per slice.
    for ordered_by in re.findall(r"windowspecdefinition\((\w+)#\d+\w* (?:ASC|DESC)", text):
        assert ordered_by == "_slice"


def test_texts_are_spread_by_their_size(spark, tmp_path, monkeypatch):
    """Small shuffle partitions are not merged into ones whose words a task cannot hold."""
    from functools import partial

    from countertide.plans import skew
    from countertide.sources import bindings

    rows = [(i, "alpha beta gamma " * 10, "en", "web", 170) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(bindings, "spread_texts", partial(skew.spread_texts, chars=400))
    tables = bindings.Tables(spark, str(tmp_path))
    assert tables.texts().rdd.getNumPartitions() == 17  # 6800 characters
    built = tables._build_videos()
    assert built.rdd.getNumPartitions() == 17
    assert {r.tags for r in built.collect()} == {"alpha,beta,gamma"} and built.count() == 40
    empty = tables.given("documents").limit(0).select("doc_id", "text")
    assert skew.spread_texts(empty, "doc_id", "text").count() == 0


def test_rows_of_a_fit_are_deleted_with_its_end(spark):
    with frozen_while(spark.range(5), "brief") as kept:
        folder = os.path.dirname(kept.inputFiles()[0].removeprefix("file://"))
        assert kept.count() == 5 and os.path.isdir(folder)
    assert not os.path.exists(folder)
    with pytest.raises(KeyError), frozen_while(spark.range(5), "brief") as kept:
        folder = os.path.dirname(kept.inputFiles()[0].removeprefix("file://"))
        raise KeyError
    assert not os.path.exists(folder)
