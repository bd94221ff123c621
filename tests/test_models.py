"""Models by their contracts: ranges, determinism, and what they must be able to learn."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from countertide.operators import features, forest, models, vectors


def test_split_is_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "video_id")
    a = {r.video_id: r.split for r in models.split(df).collect()}
    b = {r.video_id: r.split for r in models.split(df.repartition(7)).collect()}
    assert a == b and 0.15 < sum(v == "test" for v in a.values()) / 2000 < 0.25
    other = {r.video_id: r.split for r in models.split(df, seed=7).collect()}
    assert other != a


def test_folds_and_f1_without_positives(spark):
    df = spark.range(100).withColumnRenamed("id", "video_id")
    folds = {r[0] for r in models.with_folds(df, ["video_id"], 3).select("_fold").collect()}
    assert folds == {0, 1, 2}
    none = spark.createDataFrame([(0.0, 0.0)], "_label double, prediction double")
    assert models.PositiveF1().evaluate(none) == 0.0
    some = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0)], "_label double, prediction double")
    assert models.PositiveF1().evaluate(some) == pytest.approx(2 / 3)


def test_grid_is_sampled_without_repeats():
    grid = models.sampled_grid(models.CLICKBAIT_SEARCH, 20)
    assert len(grid) == 20 == len({tuple(g.items()) for g in grid})
    assert grid == models.sampled_grid(models.CLICKBAIT_SEARCH, 20)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "y int")
    got = {r.y: r.weight for r in models.balanced_weights(df, "y").collect()}
    assert got == {0: pytest.approx(4 / 6), 1: pytest.approx(4 / 2)}


# ---------------------------------------------------------------- isolation forest


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(0)
    points = rng.normal(0, 1, (2000, 3))
    points[:15] += 9
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "video_id long, a double, b double, c double").repartition(5)


def test_forest_finds_outliers(cloud):
    model = forest.fit_isolation_forest(cloud, ("a", "b", "c"), trees=60, contamination=0.01)
    scored = model.score(cloud)
    flagged = {r.video_id for r in scored.filter("is_anomaly").collect()}
    assert 10 <= len(flagged) <= 21
    assert set(range(15)) <= flagged
    assert all(len(t) <= 2 * model.sample_size - 1 for t in model.nodes) and len(model.nodes) == 60
    ends = scored.agg(F.min("score"), F.max("score")).first()
    assert -1 <= ends[0] < 0 < ends[1] <= 1
    assert model.feature_importance() == {"a": 1.0, "b": 1.0, "c": 1.0}


def test_forest_is_repeatable(cloud):
    a = forest.fit_isolation_forest(cloud, ("a", "b", "c"), trees=10)
    b = forest.fit_isolation_forest(cloud.repartition(3), ("a", "b", "c"), trees=10)
    assert a.offset == b.offset and all((x == y).all() for x, y in zip(a.nodes, b.nodes))


def test_scores_equal_a_walk_by_hand(spark, cloud):
    model = forest.fit_isolation_forest(cloud, ("a", "b", "c"), trees=5)
    rows = model.score(cloud).filter("video_id < 20").collect()
    for r in rows:
        x, total = (r.a, r.b, r.c), 0.0
        for tree in model.nodes:
            node = 0
            while tree["feature"][node] >= 0:
                node = tree["left"][node] if x[tree["feature"][node]] <= tree["split"][node] else tree["right"][node]
            total += tree["length"][node]
        want = -(2.0 ** (-(total / 5) / float(forest.expected_path(model.sample_size))))
        assert r.score == pytest.approx(want - model.offset)


def test_forest_of_equal_rows(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(30)], "video_id long, a double")
    model = forest.fit_isolation_forest(df, ("a",), trees=5)
    assert model.score(df).filter("is_anomaly").count() == 0


def test_expected_path():
    assert list(forest.expected_path(np.array([0, 1, 2]))) == [0, 0, 1]
    assert float(forest.expected_path(256)) == pytest.approx(10.2448, abs=1e-3)


# ---------------------------------------------------------------- text


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    topics = {"Gaming": "minecraft speedrun block craft server", "Music": "song guitar chord melody band"}
    rows = []
    for i in range(300):
        genre = rng.choice(list(topics))
        words = rng.choices(topics[genre].split(), k=8) + rng.choices("video new best daily great".split(), k=4) + ["the"]
        rows.append((i, " ".join(words), genre))
    return spark.createDataFrame(rows, "video_id long, text string, genre string")


def test_long_and_vector_weights_agree(corpus):
    long = {(r.video_id, r.term): r.weight for r in vectors.tfidf(corpus).collect()}
    weighted, model = vectors.fit_text_vectors(corpus)
    words = model.stages[0].vocabulary
    assert "the" not in words
    got = {}
    for r in weighted.select("video_id", "tfidf").collect():
        got.update({(r.video_id, words[i]): v for i, v in zip(r.tfidf.indices, r.tfidf.values)})
    assert got.keys() == long.keys()
    assert all(got[k] == pytest.approx(long[k]) for k in got)


def test_vocabulary_limits(corpus):
    terms = {r.term for r in vectors.tfidf(corpus, max_terms=3, max_doc_share=0.5).select("term").distinct().collect()}
    assert len(terms) <= 3


def test_svd_is_the_uncentred_one(corpus):
    weighted, model = vectors.fit_text_vectors(corpus)
    reduced, basis = vectors.truncated_svd(weighted, "tfidf", 4)
    rows = reduced.orderBy("video_id").collect()
    x = np.array([r.tfidf.toArray() for r in rows])
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    _, values = vectors.fit_svd(weighted, "tfidf", 4)
    assert np.allclose(values, s[:4])
    assert np.allclose(np.abs(basis.T @ vt[:4].T).diagonal(), 1, atol=1e-6)
    assert np.allclose(np.array([r.reduced.toArray() for r in rows]), x @ basis)


def test_svd_rows_are_not_held_by_executors(spark, corpus, monkeypatch):
    weighted, _ = vectors.fit_text_vectors(corpus)
    real, seen = vectors._gram_times, []

    def watched(rows, q):
        held = not spark._jsparkSession.sharedState().cacheManager().isEmpty()
        seen.append((held, "FileScan parquet" in rows._jdf.queryExecution().executedPlan().toString()))
        return real(rows, q)

    spark.catalog.clearCache()
    monkeypatch.setattr(vectors, "_gram_times", watched)
    vectors.fit_svd(weighted, "tfidf", 3)
    assert len(seen) == 6 and set(seen) == {(False, True)}


@pytest.mark.parametrize("partitions", [1, 40])
def test_gram_pass_is_whole_and_its_blocks_are_few(spark, partitions):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 9)) * (rng.random((700, 9)) < 0.4)
    sparse = [([int(i) for i in r.nonzero()[0]], [float(v) for v in r[r != 0]]) for r in x]
    sparse[:3] = [(None, [float(v) for v in r]) for r in x[:3]]  # dense vectors have no indices
    rows = spark.createDataFrame(sparse, "indices array<int>, values array<double>").repartition(partitions)
    q = rng.normal(size=(9, 4))
    settings = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = [spark.conf.get(s) for s in settings]
    assert np.allclose(vectors._gram_times(rows, q), x.T @ x @ q)
    assert [spark.conf.get(s) for s in settings] == before
    assert np.allclose(vectors._gram_times(rows.limit(0), q), 0)


def test_projection_sends_no_rows_to_python(spark):
    v = np.random.default_rng(6).normal(size=(7, 40))
    rows = [(1, Vectors.sparse(7, [1, 5], [2.0, -1.0])), (2, Vectors.sparse(7, [], [])), (3, Vectors.dense(np.arange(7.0)))]
    got = vectors.project(spark.createDataFrame(rows, ["video_id", "x"]), "x", v)
    assert "Python" not in got._jdf.queryExecution().optimizedPlan().toString()
    for r in got.collect():
        assert np.allclose(r.reduced.toArray(), r.x.toArray() @ v)


def test_genre_model_learns_its_keywords(spark, corpus):
    trained = models.train_genre(corpus, candidates=(3, 6), hidden=(8, 4), epochs=40)
    got = {r.split: r.accuracy for r in trained.metrics.collect()}
    assert got["test"] > 0.9
    fresh = spark.createDataFrame([(1, "Minecraft!", ["speedrun"]), (2, None, ["guitar", "chord"]), (3, "", None)], "video_id long, title string, tags array<string>")
    scored = {r.video_id: r for r in models.score_genre(trained, fresh).collect()}
    assert scored[1].label == "Gaming" and scored[2].label == "Music"
    assert all(0 <= r.probability <= 1 for r in scored.values()) and len(scored) == 3


def test_svd_choice_needs_rows(corpus):
    weighted, _ = vectors.fit_text_vectors(corpus.withColumn("label", F.lit(0.0)))
    assert models.choose_svd_k(weighted, "label", (3,), min_rows=1000).count() == 0
    assert models.choose_svd_k(weighted, "label", (3000,), min_rows=10).count() == 0


# ---------------------------------------------------------------- tabular


@pytest.fixture(scope="module")
def velocity_rows(spark):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        start = rng.uniform(2, 8)
        inputs = [0.0, 1.0, 3, 0, start, 4.0, start / 3, 0.3, 0.1, 0.01, 5.0, 20, 0.1, 0, 0, 1, rng.randrange(3)]
        rows.append((i, *inputs, int(np.exp(start) * 3)))
    ints = {"publish_day", "is_weekend", "title_len", "exclamation_count", "question_count", "has_digits", "category_id"}
    schema = ", ".join(f"{c} {'int' if c in ints else 'double'}" for c in features.VELOCITY_FEATURES)
    return spark.createDataFrame(rows, f"video_id long, {schema}, views long")


def test_velocity_model(spark, velocity_rows):
    trained = models.train_velocity(velocity_rows, trees=15, depth=4, rate=0.3, loss="squared")
    got = {r.split: r for r in trained.metrics.collect()}
    assert got["test"].log_r2 > 0.8 and set(got) == {"train", "test"}
    broken = velocity_rows.limit(3).withColumn("caps_ratio", F.when(F.col("video_id") < 0, 0.1))
    scored = models.score_velocity(trained, velocity_rows.unionByName(broken)).collect()
    assert all((r.prediction is None) == (r.reason == "missing_input") for r in scored)
    assert all(r.prediction >= 0 for r in scored if r.prediction is not None)
    assert sum(r.reason is not None for r in scored) == 3
    ranked = models.feature_importance(trained, velocity_rows).collect()
    assert len(ranked) == 17 and {r.feature for r in ranked[-2:]} & {"log_start_views", "initial_virality_slope"}
    with pytest.raises(ValueError, match="caps_ratio"):
        models.score_velocity(trained, velocity_rows.drop("caps_ratio"))


def test_clickbait_model(spark):
    rng = random.Random(2)
    rows = []
    for i in range(240):
        bait = rng.random() < 0.4
        rows.append((rng.randrange(5, 60), 0.5 if bait else 0.05, 3 if bait else 0, 0, 1, 0.0, 1.0, i % 7, i % 2, int(bait)))
    schema = "title_len int, caps_ratio double, exclamation_count int, question_count int, has_digits int, hour_sin double, hour_cos double, publish_day int, is_weekend int, is_clickbait int"
    table = spark.createDataFrame(rows, schema).distinct()
    trained = models.train_clickbait(table, space={"maxIter": (3,), "maxDepth": (2, 3)}, n_settings=2, folds=2)
    assert {r.split: r.f1 for r in trained.metrics.collect()}["test"] > 0.9
    asked = spark.createDataFrame([(1, "  WOW!!! LOOK!!!  ", 99, -4, None), (2, "a quiet walk", None, 3, 1)], "video_id long, title string, publish_hour int, publish_day int, is_weekend int")
    prepared = models.clickbait_request_features(asked).orderBy("video_id").collect()
    assert (prepared[0].title_len, prepared[0].publish_day, prepared[0].is_weekend) == (14, 0, 0)
    assert prepared[0].hour_sin == pytest.approx(np.sin(2 * np.pi * 23 / 24))
    got = {r.video_id: r for r in models.score_clickbait(trained, asked).collect()}
    assert got[1].label == "Clickbait" and got[2].label == "Solid"
    assert got[1].probability > 0.5 > got[2].probability >= 0


def test_viral_model(spark):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        x = rng.gauss(0, 1)
        rows.append((i, *([x] + [0.1] * 16), int(x > 0.5)))
    schema = ", ".join(f"{c} double" for c in features.VIRAL_FEATURES)
    table = spark.createDataFrame(rows, f"video_id long, {schema}, is_viral int")
    trained = models.train_viral(table, inverse_strength=(0.1, 10.0), folds=2, max_iter=30)
    got = {r.split: r for r in trained.metrics.collect()}
    assert got["test"].f1 > 0.7
    scored = models.score_viral(trained, table).collect()
    assert all(0 <= r.probability <= 1 and r.label in ("Viral", "Not Viral") for r in scored)
    assert models.feature_importance(trained, table).collect()[-1].feature == "like_velocity"


def test_viral_requests_fix_the_tracking_window(spark):
    row = models.viral_request_features(spark.createDataFrame([(np.log1p(100.0).item(),)], "log_start_views double")).first()
    assert row.start_views == pytest.approx(100) and row.hours_tracked == 2.0 and row.snapshots == 2


def test_probability_vectors_sum_to_one(spark, corpus):
    trained = models.train_genre(corpus, candidates=(3,), hidden=(4,), epochs=5)
    sums = trained.scored.select(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_evaluation_features_use_snapshot_time(spark):
    df = spark.createDataFrame(
        [("v", "Hi", 100, 10, 5, None, dt.datetime(2024, 1, 6, 6))],
        "video_id string, title string, views long, likes long, comments long, duration_seconds int, time timestamp",
    )
    row = features.evaluation_features(df).first()
    assert (row.publish_day, row.is_weekend, row.duration_seconds) == (5, 1, 300)
    assert row.log_start_views == pytest.approx(np.log1p(20)) and row.viral_view_velocity == pytest.approx(100 / 24)
    assert row.hour_sin == pytest.approx(1)
