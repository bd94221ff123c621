"""Association rules against all splits of all itemsets, and on itemsets too large for that."""

from __future__ import annotations

import itertools
import random

import pytest

from countertide.operators.rules import association_rules, frequent_itemsets


def plain(sets, min_lift, min_confidence):
    support = {frozenset(i): s for i, s in sets}
    out = set()
    for items, s in support.items():
        for k in range(1, len(items)):
            for consequent in map(frozenset, itertools.combinations(sorted(items), k)):
                antecedent = items - consequent
                if antecedent in support and consequent in support:
                    confidence = s / support[antecedent]
                    if confidence > min_confidence and confidence / support[consequent] >= min_lift:
                        out.add((tuple(sorted(antecedent)), tuple(sorted(consequent)), round(confidence, 9)))
    return out


def found(df):
    rows = [(tuple(sorted(r.antecedents)), tuple(sorted(r.consequents)), round(r.confidence, 9)) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("min_confidence, min_lift", [(0.2, 0.0), (0.5, 1.2), (0.9, 1.0)])
def test_equals_all_splits(spark, min_confidence, min_lift):
    r = random.Random(6)
    baskets = [sorted({x for x in "abcdefg" if r.random() < 0.55} | ({"a", "b", "c"} if r.random() < 0.3 else {"g"})) for _ in range(200)]
    mined = frequent_itemsets(spark.createDataFrame([(b,) for b in baskets], "items array<string>"), min_support=0.05)
    sets = [(r.items, r.support) for r in mined.collect()]
    assert max(len(i) for i, _ in sets) >= 5
    got = found(association_rules(mined, min_lift, min_confidence))
    assert got == plain(sets, min_lift, min_confidence) and got


def test_a_large_itemset_spells_out_confident_rules_only(spark):
    """25 items have 33 million splits; two of its items are confident consequents, so three candidates are enough."""
    items = [f"t{k:02d}" for k in range(25)]
    without = lambda *gone: [i for i in items if i not in gone]
    sets = [(items, 0.1), *((without(i), 0.11 if i in ("t03", "t07") else 0.5) for i in items), (without("t03", "t07"), 0.12)]
    sets += [([i], 0.2) for i in items] + [(["t03", "t07"], 0.15)]
    df = spark.createDataFrame(sets, "items array<string>, support double")
    got = {(len(a), c) for a, c, _ in found(association_rules(df, 1.0, 0.6).filter("size(antecedents) > 20"))}
    assert got == {(24, ("t03",)), (24, ("t07",)), (23, ("t03", "t07")), (23, ("t03",)), (23, ("t07",))}


def test_no_itemset_has_two_items(spark):
    df = spark.createDataFrame([(["a"], 0.5)], "items array<string>, support double")
    assert association_rules(df).count() == 0
