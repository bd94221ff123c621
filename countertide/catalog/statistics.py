"""Evaluation metrics, distributions, drift, integrity and gates: A4-A26, M31-M35."""

from __future__ import annotations

from pyspark.sql import functions as F

from countertide.catalog.feature_tables import bait_rows
from countertide.catalog.registry import query
from countertide.catalog.selections import asof
from countertide.operators import exact_ks, gates, integrity, metrics, stats
from countertide.operators.select import stats_with_metadata

# Truth and prediction come from the labelled documents: quality against a size rule.
_RATED_SQL = """SELECT l.doc_id, l.quality AS y, CAST(d.n_chars > 1500 AS INTEGER) AS p, d.lang AS lang,
       CASE WHEN d.n_chars % 3 = 0 THEN 'en' ELSE d.lang END AS guess, d.source,
       (d.n_chars % 200) / 100.0e0 AS score
FROM labels l JOIN documents d USING (doc_id)"""


def _rated(t):
    d = t.given("documents")
    return t.given("labels").join(d, "doc_id").select(
        "doc_id",
        F.col("quality").alias("y"),
        (F.col("n_chars") > 1500).cast("int").alias("p"),
        "lang",
        F.when(F.col("n_chars") % 3 == 0, "en").otherwise(F.col("lang")).alias("guess"),
        "source",
        (F.col("n_chars") % 200 / 100.0).alias("score"),
    )


_BINARY_SQL = """SELECT avg(CAST(y = p AS DOUBLE)) AS accuracy,
       coalesce(2.0e0 * sum(y * p) / nullif(sum(y) + sum(p), 0), 0) AS f1,
       coalesce(CAST(sum(y * p) AS DOUBLE) / nullif(sum(p), 0), 0) AS precision,
       coalesce(CAST(sum(y * p) AS DOUBLE) / nullif(sum(y), 0), 0) AS recall FROM ({rows})"""
_WEIGHTED_SQL = """SELECT sum(hits) / sum(support) AS accuracy,
       sum(support * coalesce(2.0e0 * hits / nullif(support + predicted, 0), 0)) / sum(support) AS f1,
       sum(support * coalesce(CAST(hits AS DOUBLE) / nullif(predicted, 0), 0)) / sum(support) AS precision,
       sum(support * coalesce(CAST(hits AS DOUBLE) / nullif(support, 0), 0)) / sum(support) AS recall
FROM (SELECT label, count(*) FILTER (y = label) AS support, count(*) FILTER (p = label) AS predicted,
             count(*) FILTER (y = label AND p = label) AS hits
      FROM (SELECT DISTINCT y AS label FROM ({rows}) UNION SELECT DISTINCT p FROM ({rows})), ({rows}) r GROUP BY label)"""
_FOUR = "accuracy f1 precision recall"
_LANG_ROWS = f"SELECT lang AS y, guess AS p FROM ({_RATED_SQL})"


@query("classification_metrics", _BINARY_SQL.format(rows=_RATED_SQL), doubles=_FOUR)
def _(t):
    return metrics.classification_metrics(_rated(t), "y", "p")


@query("classification_metrics_multiclass", _WEIGHTED_SQL.format(rows=_LANG_ROWS), doubles=_FOUR)
def _(t):
    return metrics.classification_metrics(_rated(t), "lang", "guess")


_ROUNDED = f"SELECT y, CAST(round_even(score, 0) AS INTEGER) AS p FROM ({_RATED_SQL})"


@query("evaluate", _WEIGHTED_SQL.format(rows=_ROUNDED), doubles=_FOUR)
def _(t):
    return metrics.evaluate_classification(_rated(t), "y", "score")


@query(
    "evaluate_binary",
    f"""SELECT avg(CAST(y = p AS DOUBLE)) AS accuracy,
       2.0e0 * count(*) FILTER (y = 1 AND p = 1) / (count(*) FILTER (y = 1) + count(*) FILTER (p = 1)) AS f1,
       count(*) FILTER (y = 1 AND p = 1) / CAST(count(*) FILTER (p = 1) AS DOUBLE) AS precision,
       count(*) FILTER (y = 1 AND p = 1) / CAST(count(*) FILTER (y = 1) AS DOUBLE) AS recall FROM ({_ROUNDED})""",
    doubles=_FOUR,
)
def _(t):
    return metrics.evaluate_classification(_rated(t), "y", "score", task="binary")


@query(
    "train_test_compare",
    f"""SELECT split, accuracy, f1, precision, recall FROM (
  SELECT CASE WHEN CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 5 = 0 THEN 'test' ELSE 'train' END AS split,
         avg(CAST(y = p AS DOUBLE)) AS accuracy, coalesce(2.0e0 * sum(y * p) / nullif(sum(y) + sum(p), 0), 0) AS f1,
         coalesce(CAST(sum(y * p) AS DOUBLE) / nullif(sum(p), 0), 0) AS precision,
         coalesce(CAST(sum(y * p) AS DOUBLE) / nullif(sum(y), 0), 0) AS recall
  FROM ({_RATED_SQL}) GROUP BY 1)""",
    doubles=_FOUR,
)
def _(t):
    from countertide.operators.models import split

    return metrics.classification_metrics(split(_rated(t), ["doc_id"]), "y", "p", by=["split"])


_PRED_SQL = "SELECT video_id, time, views AS y, 40.0e0 * (likes + comments) + 50 AS p FROM stats"
_REGRESSION_SQL = """SELECT avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
       1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2,
       100 * avg(abs((y - p) / CASE WHEN y = 0 THEN 1 ELSE y END)) AS mape_percent FROM ({rows})"""


def _predicted(t):
    return t.stats().select(
        "video_id", "time", F.col("views").alias("y"), (40.0 * (F.col("likes") + F.col("comments")) + 50).alias("p")
    )


@query("regression_metrics", _REGRESSION_SQL.format(rows=_PRED_SQL), doubles="mae rmse r2 mape_percent")
def _(t):
    return metrics.regression_metrics(_predicted(t), "y", "p")


@query(
    "log_real_metrics",
    f"""SELECT * FROM ({_REGRESSION_SQL.format(rows=f"SELECT CAST(y AS DOUBLE) AS y, exp(least(ln(1 + p), 25)) - 1 AS p FROM ({_PRED_SQL})")}),
       (SELECT mae AS log_mae, rmse AS log_rmse, r2 AS log_r2, mape_percent AS log_mape_percent
        FROM ({_REGRESSION_SQL.format(rows=f"SELECT ln(1 + y) AS y, least(ln(1 + p), 25) AS p FROM ({_PRED_SQL})")}))""",
    doubles="mae rmse r2 mape_percent log_mae log_rmse log_r2 log_mape_percent",
)
def _(t):
    logs = _predicted(t).withColumn("log_prediction", F.log1p("p"))
    return metrics.log_and_real_metrics(logs, "y", "log_prediction")


@query("masked_mape", f"SELECT 100 * avg(abs(y - p) / y) AS mape FROM ({_PRED_SQL}) WHERE y <> 0", doubles="mape")
def _(t):
    return metrics.masked_mape(_predicted(t), "y", "p")


@query(
    "topk_accuracy",
    """SELECT avg(CAST(ahead < 3 AS DOUBLE)) AS topk_accuracy FROM (
  SELECT vec_id, count(*) FILTER (x > own OR (x = own AND i > y)) AS ahead
  FROM (SELECT vec_id, label % 10 AS y, embedding[label % 10 + 1] AS own, unnest(embedding) AS x,
               generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) GROUP BY vec_id)""",
    doubles="topk_accuracy",
)
def _(t):
    rows = t.given("embeddings").select((F.col("label") % 10).alias("y"), F.col("embedding").alias("probabilities"))
    return metrics.topk_accuracy(rows, "y", "probabilities", k=3)


@query(
    "confusion_matrix",
    f"""SELECT a.v AS actual, b.v AS predicted, count(r.y) AS n
FROM (VALUES (0), (1)) a(v) CROSS JOIN (VALUES (0), (1)) b(v) LEFT JOIN ({_RATED_SQL}) r ON r.y = a.v AND r.p = b.v
GROUP BY a.v, b.v""",
)
def _(t):
    return metrics.confusion_matrix(_rated(t), "y", "p")


def _histogram_sql(rows: str, bins: int) -> str:
    return f"""SELECT bin, low + bin * width AS bin_start, low + (bin + 1) * width AS bin_end, count(v) AS n
FROM (SELECT CAST(unnest(range({bins})) AS INTEGER) AS bin, low, high, (high - low) / {bins} AS width
      FROM (SELECT min(v) AS low, max(v) AS high FROM ({rows}))) e
LEFT JOIN ({rows}) r ON least(CAST(floor((v - low) * {bins} / (high - low)) AS INTEGER), {bins - 1}) = bin
GROUP BY bin, low, width"""


@query("histogram", _histogram_sql(f"SELECT CAST(y - p AS DOUBLE) AS v FROM ({_PRED_SQL})", 30), doubles="bin_start bin_end")
def _(t):
    return stats.histogram(_predicted(t).withColumn("residual", F.col("y") - F.col("p")), "residual", 30)


@query("histogram_sizes", _histogram_sql("SELECT CAST(n_chars AS DOUBLE) AS v FROM documents", 50), doubles="bin_start bin_end")
def _(t):
    return stats.histogram(t.given("documents"), "n_chars", 50)


_DRIFT_SQL = """SELECT feature, CAST(value AS DOUBLE) AS value, time >= (SELECT max(time) FROM stats) - INTERVAL 24 HOUR AS current
FROM (SELECT time, unnest(['views', 'likes', 'comments', 'duration_seconds']) AS feature,
             unnest([ln(1 + views), ln(1 + likes), ln(1 + comments), CAST(duration_seconds AS DOUBLE)]) AS value
      FROM stats JOIN videos USING (video_id))"""


def _drift(t):
    facts = stats_with_metadata(t.stats(), t.videos())
    return stats.drift_rows(facts, asof(t), 24)


@query(
    "paired_histogram",
    f"""WITH r AS ({_DRIFT_SQL}),
e AS (SELECT feature, min(value) AS low, max(value) AS high, count(*) FILTER (NOT current) AS na, count(*) FILTER (current) AS nb FROM r GROUP BY feature),
g AS (SELECT *, (high - low) / 20 AS width, CAST(unnest(range(20)) AS INTEGER) AS bin FROM e),
c AS (SELECT feature, least(CAST(floor((value - low) * 20 / (high - low)) AS INTEGER), 19) AS bin,
             count(*) FILTER (NOT current) AS a, count(*) FILTER (current) AS b FROM r JOIN e USING (feature) GROUP BY 1, 2)
SELECT feature, bin, low + bin * width AS bin_start, coalesce(a, 0) / (na * width) AS reference_density, coalesce(b, 0) / (nb * width) AS current_density
FROM g LEFT JOIN c USING (feature, bin)""",
    doubles="bin_start reference_density current_density",
)
def _(t):
    return stats.paired_histogram(_drift(t))


_CORR_COLS = ("views", "likes", "comments", "duration_seconds", "log_views", "log_likes", "log_comments", "log_duration")
_CORR_SQL = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM w" for a in _CORR_COLS for b in _CORR_COLS)


@query(
    "correlation_matrix",
    f"""WITH w AS (SELECT views, likes, comments, duration_seconds, ln(1 + views) AS log_views, ln(1 + likes) AS log_likes,
       ln(1 + comments) AS log_comments, ln(1 + duration_seconds) AS log_duration
FROM stats JOIN videos USING (video_id) WHERE time < (SELECT max(time) FROM stats) - INTERVAL 24 HOUR)
{_CORR_SQL}""",
    doubles="corr",
)
def _(t):
    from countertide.operators.select import reference_sample

    return stats.correlation_matrix(stats.with_log_columns(reference_sample(t.stats(), t.videos(), asof(t))), _CORR_COLS)


_ANOMALY_COLS = ("log_views", "like_view_ratio", "comment_view_ratio")
_ANOMALY_CORR = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM w" for a in _ANOMALY_COLS for b in _ANOMALY_COLS)


@query(
    "anomaly_correlation",
    f"""WITH w AS (SELECT ln(1 + views) AS log_views, likes / CAST(greatest(views, 1) AS DOUBLE) AS like_view_ratio,
       comments / CAST(greatest(views, 1) AS DOUBLE) AS comment_view_ratio FROM latest)
{_ANOMALY_CORR}""",
    doubles="corr",
)
def _(t):
    from countertide.catalog.feature_tables import anomaly_rows

    return stats.correlation_matrix(anomaly_rows(t), _ANOMALY_COLS)


_KS_SQL = f"""WITH r AS ({_DRIFT_SQL}),
n AS (SELECT feature, count(*) FILTER (NOT current) AS n_reference, count(*) FILTER (current) AS n_current FROM r GROUP BY feature),
s AS (SELECT feature, value, sum(count(*) FILTER (NOT current)) OVER w AS a, sum(count(*) FILTER (current)) OVER w AS b
      FROM r GROUP BY feature, value WINDOW w AS (PARTITION BY feature ORDER BY value)),
d AS (SELECT feature, n_reference, n_current, max(abs(a / CAST(n_reference AS DOUBLE) - b / CAST(n_current AS DOUBLE))) AS ks_statistic
      FROM s JOIN n USING (feature) GROUP BY ALL),
p AS (SELECT *, ks_statistic * sqrt(CAST(n_reference AS DOUBLE) * n_current / (n_reference + n_current)) AS root FROM d)
SELECT feature, n_reference, n_current, ks_statistic,
       CASE WHEN root < 0.2 THEN 1.0e0 ELSE least(greatest(list_sum(list_transform(range(1, 101),
            lambda k: (CASE WHEN k % 2 = 1 THEN 2.0e0 ELSE -2.0e0 END) * exp(-2.0e0 * k * k * root * root))), 0), 1) END AS p_value
FROM p"""


@query("ks_statistic", _KS_SQL, doubles="ks_statistic p_value")
def _(t):
    return stats.ks_two_sample(_drift(t))


@query(
    "drift_verdict",
    f"""SELECT feature, CASE WHEN p_value < 0.05 AND ks_statistic > 0.1 THEN 'drift' WHEN p_value < 0.05 THEN 'minor' ELSE 'stable' END AS verdict
FROM ({_KS_SQL})""",
)
def _(t):
    return stats.drift_verdict(stats.ks_two_sample(_drift(t))).select("feature", "verdict")


def _exact_ks_sql(rows: str) -> str:
    """The same test as a recursive walk: rows of a step are the points of an anti-diagonal; p is what left the band."""
    return f"""WITH RECURSIVE r AS MATERIALIZED ({rows}),
n AS (SELECT feature, count(*) FILTER (NOT current) AS n, count(*) FILTER (current) AS m FROM r GROUP BY feature),
s AS (SELECT feature, sum(count(*) FILTER (NOT current)) OVER w AS a, sum(count(*) FILTER (current)) OVER w AS b
      FROM r GROUP BY feature, value WINDOW w AS (PARTITION BY feature ORDER BY value)),
d AS (SELECT feature, CAST(n AS BIGINT) AS n, CAST(m AS BIGINT) AS m, CAST(max(abs(a * m - b * n)) AS BIGINT) AS gap
      FROM s JOIN n USING (feature) WHERE n > 0 AND m > 0 GROUP BY ALL),
walk AS (
  SELECT feature, n, m, gap, CAST(0 AS BIGINT) AS t, CAST(0 AS BIGINT) AS i, 1.0e0 AS f, gap <= 0 AS out FROM d
  UNION ALL
  SELECT feature, n, m, gap, t, i, sum(f), abs(i * m - (t - i) * n) >= gap
  FROM (SELECT feature, n, m, gap, t + 1 AS t, i + step AS i, f * (CASE WHEN step = 1 THEN n - i ELSE m - (t - i) END) / (n + m - t) AS f
        FROM walk, (SELECT unnest([0, 1]) AS step)
        WHERE NOT out AND t < n + m AND (CASE WHEN step = 1 THEN n - i ELSE m - (t - i) END) > 0)
  GROUP BY feature, n, m, gap, t, i)
SELECT feature, n AS n_reference, m AS n_current, CAST(gap AS DOUBLE) / n / m AS ks_statistic,
       least(coalesce(sum(f) FILTER (out), 0), 1) AS p_value, 'exact' AS method
FROM walk GROUP BY feature, n, m, gap"""


_LENGTHS_SQL = """SELECT lang AS feature, n_chars AS value, quality = 1 AS current
FROM documents JOIN labels USING (doc_id) WHERE n_chars IS NOT NULL"""


@query("ks_exact", _exact_ks_sql(_LENGTHS_SQL), doubles="ks_statistic p_value")
def _(t):
    # Do good and bad documents of a language differ in length?
    rows = t.given("documents").join(t.given("labels"), "doc_id").filter(F.col("n_chars").isNotNull())
    return exact_ks.ks_exact(rows.select(F.col("lang").alias("feature"), F.col("n_chars").alias("value"), (F.col("quality") == 1).alias("current")))


@query("ks_exact_drift", _exact_ks_sql(_DRIFT_SQL), doubles="ks_statistic p_value")
def _(t):
    return exact_ks.ks_exact(_drift(t))


@query(
    "mean_shift",
    f"""SELECT feature, avg(value) FILTER (NOT current) AS reference_mean, avg(value) FILTER (current) AS current_mean,
       avg(value) FILTER (current) - avg(value) FILTER (NOT current) AS shift FROM ({_DRIFT_SQL}) GROUP BY feature""",
    doubles="reference_mean current_mean shift",
)
def _(t):
    return stats.mean_shift(_drift(t))


@query(
    "ols_trend",
    f"SELECT count(*) AS n, regr_slope(p, y) AS slope, regr_intercept(p, y) AS intercept, regr_r2(p, y) AS r2 FROM ({_PRED_SQL})",
    doubles="slope intercept r2",
)
def _(t):
    return stats.ols_trend(_predicted(t), "p", "y")


@query(
    "class_balance",
    """SELECT count(*) FILTER (quality = 0) AS negatives, count(*) FILTER (quality = 1) AS positives,
       coalesce(CAST(count(*) FILTER (quality = 0) AS DOUBLE) / nullif(count(*) FILTER (quality = 1), 0), 1.0) AS scale_pos_weight
FROM labels""",
    doubles="scale_pos_weight",
)
def _(t):
    return metrics.class_balance(t.given("labels"), "quality")


@query(
    "anomaly_summary",
    """SELECT count(*) FILTER (s < 0) AS n_anomalies, round(count(*) FILTER (s < 0) / CAST(count(*) AS DOUBLE), 4) AS detected_rate,
       round(avg(s), 4) AS avg_normality_score, round(min(s), 4) AS most_anomalous_score
FROM (SELECT (n_chars - 60) / 1000.0e0 AS s FROM documents)""",
    doubles="detected_rate avg_normality_score most_anomalous_score",
)
def _(t):
    scored = t.given("documents").select(((F.col("n_chars") - 60) / 1000.0).alias("score"))
    return metrics.anomaly_summary(scored.withColumn("is_anomaly", F.col("score") < 0))


_INTEGRITY_SQL = """WITH d AS (SELECT source, lang, CAST(length(text) > 1000 AS INTEGER) AS long, 7 AS seven, quality
           FROM documents LEFT JOIN labels USING (doc_id)),
n AS (SELECT count(*) AS n FROM d),
g AS (SELECT source, lang, long, seven, quality, count(*) AS c FROM d GROUP BY ALL),
h AS (SELECT count(*) AS kinds, sum(c) AS r FROM g GROUP BY source, lang, long, seven)
SELECT 'rows' AS check, '*' AS "column", CAST(n AS DOUBLE) AS value, n >= 50 AS passed FROM n
UNION ALL SELECT 'null_share', c, v, v <= 0.05 FROM (
  SELECT unnest(['source', 'lang', 'long', 'seven', 'quality']) AS c,
         unnest([count(*) - count(source), count(*) - count(lang), count(*) - count(long), count(*) - count(seven), count(*) - count(quality)])
         / CAST((SELECT n FROM n) AS DOUBLE) AS v FROM d)
UNION ALL SELECT 'constant', c, CAST(v AS INTEGER), NOT v FROM (
  SELECT unnest(['source', 'lang', 'long', 'seven', 'quality']) AS c,
         unnest([min(source) = max(source), min(lang) = max(lang), min(long) = max(long), min(seven) = max(seven), min(quality) = max(quality)]) AS v FROM d)
UNION ALL SELECT 'correlation', 'long~seven', NULL, TRUE
UNION ALL SELECT 'correlation', 'long~quality', corr(long, quality), abs(corr(long, quality)) <= 0.95 FROM d
UNION ALL SELECT 'correlation', 'seven~quality', NULL, TRUE
UNION ALL SELECT 'duplicate_share', '*', v, v <= 0 FROM (SELECT sum(c - 1) / CAST((SELECT n FROM n) AS DOUBLE) AS v FROM g)
UNION ALL SELECT 'conflict_share', 'quality', v, v <= 0 FROM (SELECT coalesce(sum(r) FILTER (kinds > 1), 0) / CAST((SELECT n FROM n) AS DOUBLE) AS v FROM h)"""


@query("integrity_report", _INTEGRITY_SQL, doubles="value")
def _(t):
    rows = t.given("documents").join(t.given("labels"), "doc_id", "left")
    return integrity.integrity_report(
        rows.select("source", "lang", (F.length("text") > 1000).cast("int").alias("long"), F.lit(7).alias("seven"), "quality"),
        label="quality",
    )


@query("integrity_report_clickbait")
def _(t):
    return integrity.integrity_report(bait_rows(t), label="is_clickbait")


_HALVES = f"""SELECT (SELECT f1 FROM ({_BINARY_SQL.format(rows=_RATED_SQL)})) AS new_score,
       (SELECT f1 FROM ({_BINARY_SQL.format(rows=f"SELECT y, 1 AS p FROM ({_RATED_SQL})")})) AS old_score"""


@query(
    "champion_gate",
    f"SELECT 'f1' AS metric, new_score, old_score, new_score - old_score AS gain, new_score - old_score >= 0 AS promoted FROM ({_HALVES})",
    doubles="new_score old_score gain",
)
def _(t):
    rated = _rated(t)
    new = metrics.classification_metrics(rated, "y", "p")
    old = metrics.classification_metrics(rated.withColumn("p", F.lit(1)), "y", "p")
    return gates.champion_gate(new, old, "f1")


@query(
    "champion_gate_lower_is_better",
    f"""SELECT 'rmse' AS metric, new_score, old_score, old_score - new_score AS gain, old_score - new_score >= 0.01 AS promoted
FROM (SELECT sqrt(avg((y - p) * (y - p))) AS new_score, sqrt(avg(CAST(y AS DOUBLE) * y)) AS old_score FROM ({_PRED_SQL}))""",
    doubles="new_score old_score gain",
)
def _(t):
    new = metrics.regression_metrics(_predicted(t), "y", "p")
    old = metrics.regression_metrics(_predicted(t).withColumn("p", F.lit(0.0)), "y", "p")
    return gates.champion_gate(new, old, "rmse", min_gain=0.01)


@query(
    "bounds_gate",
    f"SELECT accuracy BETWEEN 0.2 AND 1 AS promoted FROM ({_BINARY_SQL.format(rows=_RATED_SQL)})",
)
def _(t):
    return gates.bounds_gate(metrics.classification_metrics(_rated(t), "y", "p"), gates.GENRE_BOUNDS)


@query(
    "anomaly_bounds_report",
    """SELECT 'detected_rate' AS metric, 0.001e0 AS low, 0.1e0 AS high, value, value BETWEEN 0.001 AND 0.1 AS inside
FROM (SELECT round(count(*) FILTER (n_chars < 60) / CAST(count(*) AS DOUBLE), 4) AS value FROM documents)""",
    doubles="low high value",
)
def _(t):
    scored = t.given("documents").select(((F.col("n_chars") - 60) / 1000.0).alias("score"))
    summary = metrics.anomaly_summary(scored.withColumn("is_anomaly", F.col("score") < 0))
    return gates.bounds_report(summary, gates.ANOMALY_BOUNDS)
