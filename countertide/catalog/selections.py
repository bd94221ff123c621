"""Filters, set operations, samples and top-k: P1-P11, U1-U6, K1-K5, S8-S10."""

from __future__ import annotations

from pyspark.sql import functions as F

from countertide.catalog.logical_sql import clean
from countertide.catalog.registry import query
from countertide.functions.stopwords import ENGLISH_STOP_WORDS
from countertide.functions.text import clean_text
from countertide.operators import history, ingest, pairs, select, stats, vectors

_ASOF = "(SELECT max(time) FROM stats)"
_FACTS = "SELECT s.video_id, s.time, s.views, s.likes, s.comments, v.title, v.duration_seconds FROM stats s JOIN videos v USING (video_id)"


def asof(t):
    return select.latest_time(t.stats())


@query(
    "recent_stats",
    f"""SELECT video_id, title, duration_seconds, views, likes, comments, time FROM ({_FACTS})
WHERE time >= {_ASOF} - INTERVAL 7 DAY ORDER BY time DESC, video_id""",
)
def _(t):
    return select.recent_stats(t.stats(), t.videos(), asof(t), days=7)


@query("reference_sample", f"SELECT * FROM ({_FACTS}) WHERE time < {_ASOF} - INTERVAL 24 HOUR")
def _(t):
    return select.reference_sample(t.stats(), t.videos(), asof(t))


@query("live_sample", f"SELECT * FROM ({_FACTS}) WHERE time >= {_ASOF} - INTERVAL 24 HOUR")
def _(t):
    return select.live_sample(t.stats(), t.videos(), asof(t))


@query(
    "hash_ordered_sample",
    f"""SELECT * FROM ({_FACTS}) WHERE time < {_ASOF} - INTERVAL 24 HOUR
ORDER BY md5(video_id || '|' || epoch_us(time)) LIMIT 5000""",
)
def _(t):
    return select.reference_sample(t.stats(), t.videos(), asof(t), n=5000)


@query(
    "due_followups",
    f"""SELECT DISTINCT video_id FROM videos, (VALUES (24), (48), (168)) AS lag(h)
WHERE first_seen_at BETWEEN {_ASOF} - to_hours(h) - INTERVAL 90 MINUTE AND {_ASOF} - to_hours(h) + INTERVAL 90 MINUTE""",
)
def _(t):
    return select.due_followups(t.videos(), asof(t))


@query(
    "followup_union",
    f"""SELECT video_id FROM videos WHERE first_seen_at BETWEEN {_ASOF} - INTERVAL 1530 MINUTE AND {_ASOF} - INTERVAL 1350 MINUTE
UNION SELECT video_id FROM videos WHERE first_seen_at BETWEEN {_ASOF} - INTERVAL 2970 MINUTE AND {_ASOF} - INTERVAL 2790 MINUTE
UNION SELECT video_id FROM videos WHERE first_seen_at BETWEEN {_ASOF} - INTERVAL 10170 MINUTE AND {_ASOF} - INTERVAL 9990 MINUTE""",
)
def _(t):
    now = asof(t)
    return select.distinct_ids(*[select.due_followups(t.videos(), now, lags=[h]) for h in (24, 48, 168)])


@query(
    "min_baseline",
    "SELECT video_id, greatest(start_views, 0) AS start_views, greatest(target_views, 0) AS target_views "
    "FROM pairs WHERE start_views >= 10",
)
def _(t):
    return select.min_baseline(pairs.velocity_pairs(t.videos(), t.stats(), t.discovery())).select(
        "video_id", "start_views", "target_views"
    )


@query(
    "top_percentile",
    """SELECT v.video_id, l.views, l.likes FROM videos v JOIN latest l USING (video_id)
WHERE l.views >= (SELECT round(quantile_cont(views, 0.9), 6) FROM latest WHERE video_id IN (SELECT video_id FROM videos))""",
)
def _(t):
    joined = pairs.metadata_with_latest(t.videos(), t.stats()).select("video_id", "views", "likes")
    return select.top_percentile(joined, "views", 0.90, digits=6)


@query(
    "exact_quantiles",
    "SELECT quantile_cont(duration_seconds, 0.8) AS p80, quantile_cont(duration_seconds, 0.9) AS p90 FROM videos",
    doubles="p80 p90",
)
def _(t):
    from countertide.plans.ordered import exact_quantile

    values = t.videos().select("duration_seconds")
    p90 = exact_quantile(values, "duration_seconds", 0.9).scalar()
    return exact_quantile(values, "duration_seconds", 0.8, "p80").withColumn("p90", p90)


@query(
    "complete_rows",
    "SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL",
)
def _(t):
    joined = t.given("documents").select("doc_id", "lang").join(t.given("labels").select("doc_id", "quality"), "doc_id", "left")
    return select.complete_rows(joined, ["lang", "quality"])


_BLANKS = "chr(32)||chr(9)||chr(10)||chr(13)||chr(11)||chr(12)"


@query(
    "nonempty_tags",
    f"SELECT video_id, trim(title, {_BLANKS}) AS title, tags FROM videos WHERE trim(tags, {_BLANKS}) <> ''",
)
def _(t):
    return select.nonempty_tags(t.videos().select("video_id", "title", "tags"))


@query(
    "clean_numeric",
    """SELECT doc_id, coalesce(quality, 0) AS quality,
       CASE WHEN quality = 0 OR quality IS NULL THEN 0.0 ELSE CAST(n_chars AS DOUBLE) / quality END AS ratio,
       CASE WHEN n_chars <= 100 THEN 0.0 ELSE ln(n_chars - 100) END AS log_size
FROM documents LEFT JOIN labels USING (doc_id)""",
    doubles="ratio log_size",
)
def _(t):
    joined = t.given("documents").join(t.given("labels"), "doc_id", "left")
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    dirty = joined.select(
        "doc_id",
        "quality",
        F.when(F.col("quality") == 0, inf).otherwise(F.col("n_chars") / F.nullif("quality", F.lit(0))).alias("ratio"),
        F.when(F.col("n_chars") <= 100, nan).otherwise(F.log(F.greatest(F.col("n_chars") - 100, F.lit(1)))).alias("log_size"),
    )
    return select.clean_numeric(dirty)


_CHECKED = """SELECT doc_id, n_chars - 500 AS views, coalesce(quality, 0) AS duration_seconds,
       concat_ws('|', CASE WHEN n_chars - 500 < 0 THEN 'negative_views' END,
                      CASE WHEN coalesce(quality, 0) <= 0 THEN 'nonpositive_duration' END) AS errors
FROM documents LEFT JOIN labels USING (doc_id)"""


def _checked(t):
    joined = t.given("documents").join(t.given("labels"), "doc_id", "left")
    return joined.select(
        "doc_id", (F.col("n_chars") - 500).alias("views"), F.coalesce("quality", F.lit(0)).alias("duration_seconds")
    )


@query("quarantine", f"SELECT * FROM ({_CHECKED}) WHERE errors <> ''")
def _(t):
    return select.quarantine_invalid(_checked(t))[1]


@query("quarantine_passed", f"SELECT doc_id, views, duration_seconds FROM ({_CHECKED}) WHERE errors = ''")
def _(t):
    return select.quarantine_invalid(_checked(t))[0]


@query(
    "rank_history_check",
    """SELECT video_id, concat_ws('|', CASE WHEN min(rank - 3) < 1 THEN 'rank_below_one' END) AS errors
FROM trending GROUP BY video_id""",
)
def _(t):
    # The smallest rank decides, so histories are never gathered into one array.
    worst = t.trending().groupBy("video_id").agg(F.array(F.min(F.col("rank") - 3)).alias("ranks"))
    return select.validation_errors(worst, ranks="ranks").drop("ranks")


@query(
    "coerce_defaults",
    """SELECT doc_id, coalesce(CAST(quality AS DOUBLE), 300.0) AS duration_seconds, CAST(n_chars AS DOUBLE) AS views
FROM documents LEFT JOIN labels USING (doc_id)""",
)
def _(t):
    joined = t.given("documents").join(t.given("labels"), "doc_id", "left")
    return select.coerce_defaults(
        joined.select("doc_id", F.col("quality").alias("duration_seconds"), F.col("n_chars").alias("views"))
    )


@query("scan_videos", "SELECT video_id, title, tags, duration_seconds, published_at FROM videos")
def _(t):
    return select.scan_videos(t.videos())


@query("trending_history", "SELECT * FROM trending ORDER BY video_id, discovered_at, rank")
def _(t):
    return select.scan_trending_history(t.trending())


@query("retention", f"SELECT * FROM stats WHERE time >= {_ASOF} - INTERVAL 20 DAY")
def _(t):
    return ingest.apply_retention(t.stats(), asof(t), days=20)


@query(
    "intent_union",
    """SELECT video_id, query, 'search' AS type, NULL AS rank FROM discovery
UNION ALL SELECT video_id, NULL, 'trending', CAST(rank AS VARCHAR) FROM trending""",
)
def _(t):
    # As text, because a nullable integer has no common form in the two engines' frames.
    return ingest.union_intents(*_intents(t)).withColumn("rank", F.col("rank").cast("string"))


def _intents(t):
    search = t.discovery().select("video_id", "query", F.lit("search").alias("type"))
    trending = t.trending().select("video_id", F.lit("trending").alias("type"), "rank")
    return search, trending


@query("route_intents_search", "SELECT video_id, query FROM discovery")
def _(t):
    return ingest.route_intents(ingest.union_intents(*_intents(t)))[0]


@query("route_intents_trending", "SELECT video_id, rank FROM trending")
def _(t):
    return ingest.route_intents(ingest.union_intents(*_intents(t)))[1]


@query("distinct_ids", "SELECT video_id FROM discovery UNION SELECT video_id FROM trending")
def _(t):
    return select.distinct_ids(t.discovery(), t.trending())


@query("id_difference", "SELECT video_id FROM videos EXCEPT SELECT video_id FROM stats")
def _(t):
    return select.id_difference(t.videos(), t.stats())


@query("dedupe_latest", "SELECT * FROM trending QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY discovered_at DESC, id DESC) = 1")
def _(t):
    return history.latest_per_key(t.trending(), time="discovered_at", tie=["id"])


@query("dedupe_rows", "SELECT DISTINCT source, lang, n_chars % 10 = 0 AS round_size FROM documents")
def _(t):
    return select.dedupe_rows(t.given("documents").select("source", "lang", (F.col("n_chars") % 10 == 0).alias("round_size")))


@query(
    "newest_50",
    "SELECT s.video_id, v.duration_seconds, s.views, s.likes, s.comments, s.time "
    f"FROM stats s JOIN videos v USING (video_id) WHERE s.time >= {_ASOF} - INTERVAL 7 DAY ORDER BY s.time DESC, s.video_id LIMIT 50",
)
def _(t):
    return select.newest(select.recent_stats(t.stats(), t.videos(), asof(t)).drop("title"))


_STOP = ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS)


@query(
    "top_terms",
    f"""SELECT term, CAST(sum(tf) AS BIGINT) AS total, count(*) AS docs
FROM (SELECT doc_id, term, count(*) AS tf
      FROM (SELECT doc_id, unnest(string_split({clean('text')}, ' ')) AS term FROM documents)
      WHERE length(term) >= 2 AND term NOT IN ({_STOP}) GROUP BY doc_id, term)
GROUP BY term ORDER BY total DESC, term LIMIT 5000""",
)
def _(t):
    cleaned = t.texts().select("doc_id", clean_text(F.col("text")).alias("text"))
    return vectors.top_terms(vectors.term_counts(cleaned, key="doc_id"))


@query("value_counts", "SELECT category_id, count(*) AS n FROM videos WHERE category_id IS NOT NULL GROUP BY category_id")
def _(t):
    return stats.value_counts(t.videos(), "category_id")
