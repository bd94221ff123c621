"""Tag rules and text weights: M2, M3, J8/M27, A11, M34, M15."""

from __future__ import annotations

from pyspark.sql import functions as F

from countertide.catalog.logical_sql import clean
from countertide.catalog.registry import query
from countertide.functions.stopwords import ENGLISH_STOP_WORDS
from countertide.functions.text import clean_text, tag_list
from countertide.operators import features, gates, metrics, rules, vectors

_STOP = ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS)


def _itemsets(t):
    return rules.frequent_itemsets(features.tag_transactions(t.videos()))


def _rules(t):
    return rules.association_rules(_itemsets(t), digits=6)


@query("frequent_itemsets", "SELECT array_to_string(items, '|') AS items, freq, support FROM itemsets", doubles="support")
def _(t):
    return _itemsets(t)


@query(
    "association_rules",
    """SELECT array_to_string(antecedents, '|') AS antecedents, array_to_string(consequents, '|') AS consequents,
       antecedent_support, consequent_support, support, confidence, lift FROM rules""",
    doubles="antecedent_support consequent_support support confidence lift",
)
def _(t):
    return _rules(t)


@query(
    "rule_metrics",
    """SELECT count(*) AS rule_count, coalesce(avg(lift), 0) AS avg_lift, coalesce(avg(confidence), 0) AS avg_confidence,
       coalesce(max(lift), 0) AS max_lift FROM rules""",
    doubles="avg_lift avg_confidence max_lift",
)
def _(t):
    return metrics.rule_metrics(_rules(t))


@query(
    "rule_gate",
    "SELECT count(*) BETWEEN 5 AND 10000 AND avg(lift) BETWEEN 1.05 AND 100 AS promoted FROM rules",
)
def _(t):
    return gates.bounds_gate(metrics.rule_metrics(_rules(t)), gates.RULE_BOUNDS)


@query(
    "tag_recommendations",
    """WITH listed AS (SELECT video_id, list_filter(string_split(lower(tags), ','), lambda t: t <> '') AS items FROM videos),
hits AS (SELECT l.video_id, unnest(r.consequents) AS item FROM listed l JOIN rules r ON list_has_all(l.items, r.antecedents))
SELECT l.video_id, coalesce((SELECT string_agg(item, '|' ORDER BY item) FROM (SELECT DISTINCT item FROM hits h WHERE h.video_id = l.video_id)),
                            'viral|trending|4k') AS recommended FROM listed l""",
)
def _(t):
    return rules.recommend_tags(_rules(t), t.videos().select("video_id", tag_list(F.col("tags")).alias("tags")))


@query(
    "tfidf",
    f"""WITH c AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(string_split({clean('text')}, ' ')) AS term FROM documents)
  WHERE length(term) >= 2 AND term NOT IN ({_STOP}) GROUP BY doc_id, term),
v AS (SELECT term, ln((n + 1.0e0) / (count(*) + 1.0e0)) + 1 AS idf FROM c, (SELECT count(*) AS n FROM documents)
      GROUP BY term, n HAVING count(*) >= 5 AND count(*) <= 0.95e0 * n ORDER BY sum(tf) DESC, term LIMIT 5000)
SELECT doc_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS weight FROM c JOIN v USING (term)""",
    doubles="weight",
)
def _(t):
    cleaned = t.texts().select("doc_id", clean_text(F.col("text")).alias("text"))
    return vectors.tfidf(cleaned, key="doc_id")
