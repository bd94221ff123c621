"""Models over whole tables: M16-M31. What depends on a large ensemble has no SQL; a first split and its gate have."""

from __future__ import annotations

from pyspark.sql import functions as F

from countertide.catalog.feature_tables import anomaly_rows, bait_rows, live_rows, viral_rows
from countertide.catalog.registry import query
from countertide.catalog.scalars import UPPERCASE
from countertide.functions.text import tag_list
from countertide.operators import boosting, features, forest, gates, metrics, models, pairs, stats, vectors
from countertide.operators.select import min_baseline
from countertide.plans.shared import fresh_path, freeze
from countertide.sources.model_store import ModelStore, gate_stored

_fitted: dict[tuple[str, str, str], object] = {}


def _once(t, name, fit):
    """Training and scoring queries of one session share the fitted model."""
    key = (t.spark.sparkContext.applicationId, t.folder, name)
    if key not in _fitted:
        _fitted[key] = fit()
    return _fitted[key]


def _velocity(t):
    def fit():
        pair_rows = min_baseline(pairs.velocity_pairs(t.videos(), t.stats(), t.discovery()))
        return models.train_velocity(features.velocity_features(pair_rows, uppercase=UPPERCASE))

    return _once(t, "velocity", fit)


def _clickbait(t):
    return _once(t, "clickbait", lambda: models.train_clickbait(bait_rows(t)))


def _viral(t):
    return _once(t, "viral", lambda: models.train_viral(features.viral_training_matrix(viral_rows(t))))


def _genre(t):
    return _once(t, "genre", lambda: models.train_genre(features.genre_corpus(t.videos())))


def _forest(t):
    def fit():
        return forest.fit_isolation_forest(anomaly_rows(t), features.ANOMALY_FEATURES)

    return _once(t, "anomaly", fit)


@query("train_velocity")
def _(t):
    return _velocity(t).metrics


@query("score_velocity")
def _(t):
    pair_rows = pairs.velocity_pairs(t.videos(), t.stats(), t.discovery())
    return models.score_velocity(_velocity(t), features.velocity_features(pair_rows, uppercase=UPPERCASE))


@query("score_live_velocity")
def _(t):
    # Live evaluation: every snapshot under the assumed age and start views.
    return models.score_velocity(_velocity(t), features.evaluation_features(live_rows(t)))


@query("velocity_residuals")
def _(t):
    scored = models.velocity_predictions_real(_velocity(t).scored)
    return stats.histogram(scored.selectExpr("views - prediction AS residual"), "residual", 30)


@query("train_clickbait")
def _(t):
    return _clickbait(t).metrics


@query("score_clickbait")
def _(t):
    requests = features.add_date_features(t.videos().select("video_id", "title", "published_at"))
    return models.score_clickbait(_clickbait(t), requests)


@query("train_viral")
def _(t):
    return _viral(t).metrics


@query("score_viral")
def _(t):
    return models.score_viral(_viral(t), viral_rows(t))


@query("train_genre")
def _(t):
    return _genre(t).metrics


@query("score_genre")
def _(t):
    rows = t.videos().select("video_id", "title", tag_list(F.col("tags")).alias("tags"))
    return models.score_genre(_genre(t), rows)


@query("genre_gate")
def _(t):
    test = models.test_part(_genre(t).metrics).drop("split")
    return gates.bounds_gate(test, gates.GENRE_BOUNDS)


@query("train_anomaly")
def _(t):
    return metrics.anomaly_summary(_forest(t).score(anomaly_rows(t)))


@query("anomaly_gate")
def _(t):
    return gates.bounds_gate(metrics.anomaly_summary(_forest(t).score(anomaly_rows(t))), gates.ANOMALY_BOUNDS)


@query("score_anomaly")
def _(t):
    return _forest(t).score(anomaly_rows(t)).select("video_id", "is_anomaly", "score")


@query("svd")
def _(t):
    corpus = features.genre_corpus(t.videos())
    weighted, _model = vectors.fit_text_vectors(corpus)
    reduced, _basis = vectors.truncated_svd(weighted, "tfidf", max(models.SVD_CANDIDATES))
    from pyspark.ml.functions import vector_to_array

    return reduced.select("video_id", vector_to_array("reduced").alias("reduced"))


@query("choose_svd_k")
def _(t):
    from pyspark.ml.feature import StringIndexer

    corpus = features.genre_corpus(t.videos())
    labelled = StringIndexer(inputCol="genre", outputCol="label", stringOrderType="alphabetAsc").fit(corpus).transform(corpus)
    weighted, _model = vectors.fit_text_vectors(models.train_part(models.split(labelled)))
    return models.choose_svd_k(weighted, "label")


@query("feature_importance")
def _(t):
    return models.feature_importance(_velocity(t), t.videos())


@query("feature_importance_viral")
def _(t):
    return models.feature_importance(_viral(t), t.videos())


@query("feature_importance_clickbait")
def _(t):
    return models.feature_importance(_clickbait(t), t.videos())


@query("champion_gate_viral")
def _(t):
    test = models.test_part(_viral(t).metrics).drop("split")
    return gates.champion_gate(test, None, "f1")


@query("label_encode", "SELECT video_id, genre, CAST(dense_rank() OVER (ORDER BY genre) - 1 AS DOUBLE) AS label FROM (SELECT video_id, category_id AS genre FROM videos WHERE category_id IS NOT NULL)", doubles="label")
def _(t):
    from pyspark.ml.feature import StringIndexer

    rows = t.videos().filter(F.col("category_id").isNotNull()).select("video_id", F.col("category_id").alias("genre"))
    return StringIndexer(inputCol="genre", outputCol="label", stringOrderType="alphabetAsc").fit(rows).transform(rows)


_LENGTH_INPUTS = ("n_chars", "hour", "lines")
_QUALITY_SQL = """SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars, CAST(doc_id % 72 AS DOUBLE) AS hour,
       CAST(length(text) - length(replace(text, chr(10), '')) AS DOUBLE) AS lines, CAST(quality AS DOUBLE) AS y,
       CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 5 = 0 AS test
FROM labels JOIN documents USING (doc_id) WHERE text IS NOT NULL"""
# A tree of one split, all borders tried: gains of both sides over the undivided rows, penalty 1.
_STUMP_SQL = f"""rows AS MATERIALIZED ({_QUALITY_SQL}),
base AS (SELECT round(avg(y), 9) AS b FROM rows WHERE NOT test),
long AS (SELECT doc_id, y, unnest([0, 1, 2]) AS k, unnest([n_chars, hour, lines]) AS x FROM rows WHERE NOT test),
border AS (SELECT DISTINCT k, unnest(quantile_disc(x, [p / 64.0e0 FOR p IN range(1, 64)])) AS cut FROM long GROUP BY k),
sums AS (SELECT k, cut, sum(b - y) FILTER (x <= cut) AS gl, count(*) FILTER (x <= cut) AS nl, sum(b - y) FILTER (x > cut) AS gr,
                count(*) FILTER (x > cut) AS nr FROM long JOIN border USING (k), base GROUP BY k, cut),
split AS (SELECT k, cut, coalesce(gl, 0) ** 2 / (nl + 1) + coalesce(gr, 0) ** 2 / (nr + 1)
                 - (coalesce(gl, 0) + coalesce(gr, 0)) ** 2 / (nl + nr + 1) AS gain, -gl / (nl + 1) AS low, -gr / (nr + 1) AS high
          FROM sums WHERE nl > 0 AND nr > 0 ORDER BY round(gain, 6) DESC, k, cut LIMIT 1)"""


def _quality_rows(t):
    rows = t.given("labels").join(t.given("documents"), "doc_id").filter(F.col("text").isNotNull())
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        (F.col("doc_id") % 72).cast("double").alias("hour"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("double").alias("lines"),
        F.col("quality").cast("double").alias("y"),
    )


def _stump(train):
    return boosting.fit_boosted(train, _LENGTH_INPUTS, "y", [boosting.Setting(1, 1, 1.0, 1.0, 1, "squared")])[0]


@query(
    "boosting_root_split",
    f"""WITH {_STUMP_SQL} SELECT ['n_chars', 'hour', 'lines'][k + 1] AS feature, cut AS border, round(gain, 3) AS gain,
       round(low, 3) AS low, round(high, 3) AS high FROM split""",
)
def _(t):
    train = models.train_part(models.split(_quality_rows(t), ["doc_id"]))
    model = _stump(train)
    tree = model.trees[0]
    f, (low, high) = tree.feature[0], (tree.value[tree.left[0]], tree.value[tree.right[0]])
    row = (model.names[f], model.borders[f][tree.border[0]], *[round(float(v), 3) for v in (tree.gain[0], low, high)])
    return t.spark.createDataFrame([row], "feature string, border double, gain double, low double, high double")


@query(
    "champion_gate_stored",
    f"""WITH {_STUMP_SQL},
p AS (SELECT y, b AS old, b + CASE WHEN [n_chars, hour, lines][k + 1] <= cut THEN low ELSE high END AS new FROM rows, base, split WHERE test),
e AS (SELECT sqrt(avg((y - new) ** 2)) AS new_score, sqrt(avg((y - old) ** 2)) AS old_score FROM p)
SELECT 'rmse' AS metric, round(new_score, 4) AS new_score, round(old_score, 4) AS old_score, round(old_score - new_score, 4) AS gain,
       old_score - new_score >= 0 AS promoted, 'compared' AS reason FROM e""",
)
def _(t):
    # The champion predicts the mean, the challenger has one split; both are stored, loaded and scored on one written split.
    rows = freeze(models.split(_quality_rows(t), ["doc_id"]), "gate")
    train, test = models.train_part(rows), models.test_part(rows)
    store = ModelStore(t.spark, fresh_path(t.spark, "store"))
    champion = boosting.fit_boosted(train, _LENGTH_INPUTS, "y", [boosting.Setting(0)])[0]
    store.promote("quality", store.save("quality", champion), None)

    def score(model, df):
        return metrics.regression_metrics(model.transform(df, "p"), "y", "p")

    verdict = gate_stored(store, "quality", store.save("quality", _stump(train)), test, score, "rmse")
    return verdict.select("metric", *[F.round(c, 4).alias(c) for c in ("new_score", "old_score", "gain")], "promoted", "reason")
