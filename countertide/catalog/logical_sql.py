"""The derived tables as SQL, written independently of the Spark code."""

from __future__ import annotations

import re

from countertide.sources.bindings import (
    CATEGORY_OF_LANGUAGE,
    FIRST_SEEN_ORIGIN,
    KEYWORD_LENGTH,
    KEYWORDS,
    PUBLISH_ORIGIN,
)


def clean(expr: str) -> str:
    """Text cleaning as nested SQL functions."""
    return (
        r"trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce("
        + expr
        + r", '')), '(http|www)[^\s\p{Z}]+', '', 'g'), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
    )


STATS = """stats AS (
  SELECT video_id, time, CAST(sum(v) OVER w AS BIGINT) AS views,
         CAST(sum(l) OVER w AS BIGINT) AS likes, CAST(sum(c) OVER w AS BIGINT) AS comments
  FROM (SELECT user_id AS video_id, ts AS time, sum(CAST(floor(value) AS BIGINT)) AS v,
               count(*) FILTER (event_type = 'click') AS l, count(*) FILTER (event_type = 'purchase') AS c
        FROM events GROUP BY user_id, ts)
  WINDOW w AS (PARTITION BY video_id ORDER BY time ROWS UNBOUNDED PRECEDING))"""

TAGGED = f"""tagged AS (
  SELECT doc_id, string_agg(word, ',' ORDER BY word) AS tags
  FROM (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, word) AS place
        FROM (SELECT doc_id, unnest(string_split({clean('text')}, ' ')) AS word FROM documents)
        WHERE length(word) >= {KEYWORD_LENGTH} GROUP BY doc_id, word)
  WHERE place <= {KEYWORDS} GROUP BY doc_id)"""

_CATEGORY = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CATEGORY_OF_LANGUAGE.items())


def _videos(with_tags: bool) -> str:
    tags = "coalesce(t.tags, '') AS tags," if with_tags else ""
    join = "LEFT JOIN tagged t ON t.doc_id = d.doc_id" if with_tags else ""
    return f"""videos AS (
  SELECT d.doc_id AS video_id, d.text AS title, {tags}
         TIMESTAMP '{PUBLISH_ORIGIN}' + to_hours(CAST(d.doc_id % 72 AS INTEGER)) AS published_at,
         d.source AS channel_id, CASE d.lang {_CATEGORY} END AS category_id, d.n_chars AS duration_seconds,
         TIMESTAMP '{FIRST_SEEN_ORIGIN}' + to_hours(CAST(d.doc_id % 264 AS INTEGER)) AS first_seen_at
  FROM documents d {join})"""


DISCOVERY = """discovery AS (
  SELECT event_id AS id, user_id AS video_id, props AS query, ts AS discovered_at
  FROM events WHERE event_type = 'signup')"""

TRENDING = """trending AS (
  SELECT event_id AS id, user_id AS video_id, CAST(event_id % 50 + 1 AS INTEGER) AS rank, ts AS discovered_at
  FROM events WHERE event_type = 'view')"""

LATEST = """latest AS (
  SELECT * FROM stats QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY time DESC) = 1)"""

ENDS = """ends AS (
  SELECT video_id, min(time) AS start_time, max(time) AS end_time, count(*) AS snapshots,
         arg_min(views, time) AS start_views, arg_min(likes, time) AS start_likes,
         arg_min(comments, time) AS start_comments, arg_max(views, time) AS end_views,
         arg_max(likes, time) AS end_likes, arg_max(comments, time) AS end_comments
  FROM stats GROUP BY video_id)"""

FIRST_FOUND = """first_found AS (
  SELECT video_id, min(discovered_at) AS first_discovered FROM discovery GROUP BY video_id)"""

PAIRS = """pairs AS (
  SELECT v.video_id, v.title, v.tags, v.duration_seconds, v.published_at, v.channel_id, v.category_id,
         f.first_discovered, e.start_views, e.start_likes, e.start_comments, e.start_time,
         e.end_views AS target_views, e.end_likes, e.end_comments, e.end_time,
         date_diff('microsecond', e.start_time, e.end_time) / 3.6e9 AS hours_tracked
  FROM first_found f JOIN videos v USING (video_id) JOIN ends e USING (video_id)
  WHERE e.end_time > e.start_time + INTERVAL 2 HOUR)"""

BASKETS = """baskets AS (
  SELECT video_id, list_sort(list_distinct(items)) AS items
  FROM (SELECT video_id, list_filter(list_transform(string_split(tags, ','), lambda t: lower(trim(t))),
                                     lambda t: t <> '') AS items FROM videos)
  WHERE len(items) >= 2)"""

# Every itemset with at least 1 % of the baskets, grown item by item with its list of baskets.
ITEMSETS = """basket_count AS (SELECT count(*) AS n FROM baskets),
singles AS (
  SELECT item, list(video_id) AS owners FROM (SELECT video_id, unnest(items) AS item FROM baskets)
  GROUP BY item HAVING count(*) >= 0.01 * (SELECT n FROM basket_count)),
grown AS (
  SELECT [item] AS items, owners FROM singles
  UNION ALL
  SELECT items, owners
  FROM (SELECT list_append(g.items, s.item) AS items, list_intersect(g.owners, s.owners) AS owners
        FROM grown g JOIN singles s ON s.item > g.items[-1])
  WHERE len(owners) >= 0.01 * (SELECT n FROM basket_count)),
itemsets AS (
  SELECT items, len(owners) AS freq, len(owners) / CAST(n AS DOUBLE) AS support FROM grown, basket_count)"""

RULES = """masks AS (
  SELECT items, support, unnest(range(1, CAST(power(2, len(items)) AS BIGINT) - 1)) AS mask
  FROM itemsets WHERE len(items) > 1),
halves AS (
  SELECT support,
         list_filter(items, lambda x: ((mask >> (list_position(items, x) - 1)) & 1) = 1) AS antecedents,
         list_filter(items, lambda x: ((mask >> (list_position(items, x) - 1)) & 1) = 0) AS consequents
  FROM masks),
rules AS (
  SELECT h.antecedents, h.consequents, a.support AS antecedent_support, c.support AS consequent_support,
         h.support, h.support / a.support AS confidence, h.support / a.support / c.support AS lift
  FROM halves h JOIN itemsets a ON a.items = h.antecedents JOIN itemsets c ON c.items = h.consequents
  WHERE round(h.support / a.support, 6) > 0.5 AND round(h.support / a.support / c.support, 6) >= 1.2)"""

_ALL = [
    ("stats", lambda tags: STATS),
    ("tagged", lambda tags: TAGGED),
    ("videos", _videos),
    ("discovery", lambda tags: DISCOVERY),
    ("trending", lambda tags: TRENDING),
    ("latest", lambda tags: LATEST),
    ("ends", lambda tags: ENDS),
    ("first_found", lambda tags: FIRST_FOUND),
    ("pairs", lambda tags: PAIRS),
    ("baskets", lambda tags: BASKETS),
    ("itemsets", lambda tags: ITEMSETS),
    ("rules", lambda tags: RULES),
]


def _words(sql: str) -> set[str]:
    return set(re.findall(r"[a-z_]+", sql.lower()))


def needed_by(body: str) -> str:
    """The common table expressions that ``body`` needs, in order; empty if none."""
    seen = _words(body)
    chosen: list[str] = []
    with_tags = "tags" in seen or bool(seen & {"pairs", "baskets", "itemsets", "rules"})
    for name, text in reversed(_ALL):
        if name in seen or (name == "tagged" and with_tags and "videos" in seen):
            sql = text(with_tags)
            seen |= _words(sql)
            chosen.append(sql)
    if not chosen:
        return ""
    return ("RECURSIVE " if "grown" in seen else "") + ",\n".join(reversed(chosen))
