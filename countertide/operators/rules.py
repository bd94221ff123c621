"""Tag association rules: frequent itemsets, rules, and recommendations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countertide.plans.shared import freeze

# Mining thresholds, the relaxed support, and what is recommended when no rule applies.
MIN_SUPPORT = 0.01
RELAXED_SUPPORT = 0.005
MIN_LIFT = 1.2
MIN_CONFIDENCE = 0.5
FALLBACK_TAGS = ("viral", "trending", "4k")


def _mine(baskets: DataFrame, items: str, min_support: float, rows: int) -> DataFrame:
    model = FPGrowth(itemsCol=items, minSupport=min_support).fit(baskets.select(items))
    return model.freqItemsets.select(
        F.array_sort("items").alias("items"), "freq", (F.col("freq") / F.lit(float(rows))).alias("support")
    )


def frequent_itemsets(
    baskets: DataFrame,
    items: str = "items",
    min_support: float = MIN_SUPPORT,
    relaxed_support: float | None = RELAXED_SUPPORT,
) -> DataFrame:
    """All itemsets with at least ``min_support``, of any size; retried once at ``relaxed_support``.

    Parallel FP-growth: baskets are shuffled as prefix paths per item group and merged into trees
    map-side, so equal baskets cost one path and no item pairs are spelled out. The result is
    frozen, because rules read it three times.
    """
    rows = baskets.count()
    if rows == 0:
        raise ValueError("no baskets")
    found = freeze(_mine(baskets, items, min_support, rows), "itemsets")
    if found.isEmpty() and relaxed_support is not None:
        found = freeze(_mine(baskets, items, relaxed_support, rows), "itemsets")
    if found.isEmpty():
        raise ValueError("no frequent itemsets, even at the relaxed support")
    return found


def association_rules(
    itemsets: DataFrame, min_lift: float = MIN_LIFT, min_confidence: float = MIN_CONFIDENCE, digits: int | None = None
) -> DataFrame:
    """Rules with any number of consequents: lift at least, confidence strictly above, their bounds.

    Consequents grow an item at a time in a prefix tree over each itemset: a rule's confidence only falls as items move from
    its antecedents to its consequents, so a consequent is extended only while it is confident, and only by later items that are
    confident alone. No subset of an itemset is spelled out that has no confident rule below it. Antecedents are looked up by
    a join; each level is written, and there are as many as the largest consequent has items. ``digits`` rounds
    confidence and lift before the comparison.
    """
    supports = itemsets.select("items", "support")

    def compared(name: str):
        return F.col(name) if digits is None else F.round(name, digits)

    def confident(candidates: DataFrame) -> DataFrame:
        """Candidates (items, support, consequents, ...) with their antecedents, as far as they are confident."""
        cut = candidates.withColumn("antecedents", F.array_except("items", "consequents"))
        known = supports.select(F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support"))
        rated = cut.join(known, "antecedents").withColumn("confidence", F.col("support") / F.col("antecedent_support"))
        return rated.filter(compared("confidence") > min_confidence)

    whole = itemsets.filter(F.size("items") > 1).select(F.array_sort("items").alias("items"), "support")
    single = confident(whole.withColumn("consequents", F.explode(F.transform("items", lambda i: F.array(i)))))
    level = freeze(single, "rules-1")
    # The items that are confident alone, one row an itemset and at most as long as it.
    alone = level.groupBy("items").agg(F.array_sort(F.flatten(F.collect_list("consequents"))).alias("alone"))
    found = level
    size = 1
    while not level.isEmpty():
        size += 1
        wider = level.filter(F.size("items") > size).select("items", "support", "consequents").join(alone, "items")
        later = F.filter("alone", lambda i: i > F.element_at("consequents", -1))
        grown = wider.withColumn("_next", F.explode(later)).select("items", "support", F.concat("consequents", F.array("_next")).alias("consequents"))
        level = freeze(confident(grown), f"rules-{size}")
        found = found.unionByName(level)
    return (
        found.join(supports.select(F.col("items").alias("consequents"), F.col("support").alias("consequent_support")), "consequents")
        .withColumn("lift", F.col("confidence") / F.col("consequent_support"))
        .filter(compared("lift") >= min_lift)
        .select("antecedents", "consequents", "antecedent_support", "consequent_support", "support", "confidence", "lift")
    )


def recommend_tags(
    rules: DataFrame,
    items: DataFrame,
    key: str = "video_id",
    tags: str = "tags",
    fallback: Sequence[str] = FALLBACK_TAGS,
) -> DataFrame:
    """Consequents of every rule whose antecedents are all among the row's tags, else the fallback.

    A rule is looked up by one tag only, its antecedent that is rarest in ``items``; the others are
    checked on the spot. A tag that a third of all rows carry is thus hardly ever a join key.
    """
    lowered = items.select(key, F.array_distinct(F.transform(tags, lambda t: F.lower(t))).alias("_tags"))
    by_tag = lowered.select(key, "_tags", F.explode("_tags").alias("_tag"))
    by_antecedent = rules.groupBy("antecedents").agg(
        F.array_distinct(F.flatten(F.collect_set("consequents"))).alias("consequents")
    )
    spelled = by_antecedent.select("antecedents", "consequents", F.explode("antecedents").alias("_tag"))
    frequency = (
        by_tag.join(spelled.select("_tag").distinct(), "_tag", "left_semi")
        .groupBy("_tag")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    looked_up = (
        spelled.join(frequency, "_tag")
        .groupBy("antecedents")
        .agg(F.min_by("_tag", F.struct("_n", "_tag")).alias("_tag"), F.first("consequents").alias("consequents"))
    )
    matched = (
        by_tag.join(looked_up, "_tag")
        .filter(F.size(F.array_except("antecedents", "_tags")) == 0)
        .select(key, F.explode("consequents").alias("_rec"))
        .groupBy(key)
        .agg(F.array_sort(F.collect_set("_rec")).alias("recommended"))
    )
    default = F.array(*[F.lit(t) for t in fallback])
    return items.select(key).join(matched, key, "left").withColumn("recommended", F.coalesce("recommended", default))
