"""Checks of values, labels and identifiers before training, as a table of (check, column, value, status).

``status`` is passed, failed, or skipped where the table has too few rows to judge; a skipped check still shows its value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countertide.plans.ordered import running_totals

# Strings that stand for a missing value, compared in lower case without outer blanks.
NULL_WORDS = ("", "null", "none", "nan", "na", "n/a", "-")
#: Largest value of each check that passes; a share of mixed types fails between the two given.
LIMITS = {
    "mixed_nulls": 1.0,
    "special_characters": 0.001,
    "string_mismatch": 0.0,
    "length_outliers": 0.01,
    "predictive_power": 0.8,
    "identifier_label": 0.2,
}
RARE_TYPE = (0.01, 0.2)
FENCE = 3.0
FOLDS = 3
BINS = 16
NUMBER = r"^[+-]?[0-9]+(\.[0-9]+)?$"


def _long_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("v")) for c in columns]
    return df.select(F.inline(F.array(*cells)))


def string_checks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(check, column, value) of mixed nulls, mixed types and values without letters or digits, from one pass."""
    bare = F.lower(F.trim("v"))
    word = bare.isin(*NULL_WORDS)
    real = F.col("v").isNotNull() & ~word
    number = real & F.col("v").rlike(NUMBER)
    special = real & ~F.col("v").rlike(r"[\p{L}\p{N}]")
    kinds = sum((F.max(F.coalesce(bare == w, F.lit(False)).cast("int")) for w in NULL_WORDS), F.max(F.col("v").isNull().cast("int")))
    n, numbers = F.count_if(real), F.count_if(number)
    found = _long_strings(df, columns).groupBy("column").agg(
        kinds.cast("double").alias("mixed_nulls"),
        (F.least(numbers, n - numbers) / F.when(n > 0, n)).alias("mixed_types"),
        (F.count_if(special) / F.when(n > 0, n)).alias("special_characters"),
    )
    lines = [F.struct(F.lit(c).alias("check"), "column", F.col(c).alias("value")) for c in ("mixed_nulls", "mixed_types", "special_characters")]
    return found.select(F.inline(F.array(*lines)))


def string_mismatch(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many base forms (letters and digits in lower case) are spelled in more than one way. Only digests are shuffled."""
    base = F.regexp_replace(F.lower("v"), r"[^\p{L}\p{N}]", "")
    forms = _long_strings(df, columns).filter(F.col("v").isNotNull() & (base != "")).select("column", F.md5(base).alias("base"), F.md5("v").alias("form"))
    spelled = forms.distinct().groupBy("column", "base").agg(F.count(F.lit(1)).alias("n"))
    counted = spelled.groupBy("column").agg(F.count_if(F.col("n") > 1).cast("double").alias("value"))
    return counted.select(F.lit("string_mismatch").alias("check"), "column", "value")


def length_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of values whose length lies ``FENCE`` interquartile ranges beyond the quartiles; from counts per length."""
    counts = _long_strings(df, columns).filter("v IS NOT NULL").groupBy("column", F.length("v").alias("len")).agg(F.count(F.lit(1)).alias("n"))
    steps = running_totals(counts, ["column"], ["len"], ["n"])
    total = counts.groupBy("column").agg(F.sum("n").alias("all"))
    ranked = steps.join(F.broadcast(total), "column")
    quartile = lambda q: F.min(F.when(F.col("cum_n") >= F.ceil(F.col("all") * q), F.col("len")))
    fences = ranked.groupBy("column").agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))
    reach = FENCE * (F.col("q3") - F.col("q1"))
    outside = (F.col("len") < F.col("q1") - reach) | (F.col("len") > F.col("q3") + reach)
    share = F.sum(F.when(outside, F.col("n")).otherwise(0)) / F.sum("n")
    judged = ranked.join(F.broadcast(fences), "column").groupBy("column").agg(share.alias("value"))
    return judged.select(F.lit("length_outliers").alias("check"), "column", "value")


def _bin(name: str, borders: Mapping[str, Sequence[float]]) -> Column:
    if name not in borders:
        return F.md5(F.col(f"`{name}`").cast("string"))
    value = F.col(f"`{name}`").cast("double")
    place = sum(((value > b).cast("int") for b in borders[name]), F.lit(0)).cast("string")
    return F.when(value.isNotNull(), place)


def predictive_power(df: DataFrame, label: str, features: Sequence[str], key: Sequence[str]) -> DataFrame:
    """(feature, value): how much of the label's squared error one feature explains on rows that its bin means have not seen.

    Numbers are cut into quantile bins, other values are bins of their own, and rows fall into folds by a hash of their key.
    A row is predicted by the mean label of its bin in the other folds, or by that of all their rows where the bin has none
    there. Errors follow from counts, sums and squares by bin and fold: one aggregation, however many folds.
    """
    numeric = {c for c, kind in df.dtypes if kind in ("tinyint", "smallint", "int", "bigint", "float", "double")}
    cut = [c for c in features if c in numeric]
    borders: dict[str, list[float]] = {}
    if cut:
        shares = [k / BINS for k in range(1, BINS)]
        row = df.filter(F.col(label).isNotNull()).agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(c) for c in cut]).head()
        borders = {c: sorted(set(row[c] or [])) for c in cut}
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    fold = (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % FOLDS).cast("int")
    cells = [F.struct(F.lit(c).alias("feature"), F.coalesce(_bin(c, borders), F.lit("null")).alias("bin")) for c in features]
    rows = df.select(F.col(label).cast("double").alias("y"), fold.alias("fold"), F.inline(F.array(*cells))).filter("y IS NOT NULL")
    parts = []
    for k in range(FOLDS):
        here = F.col("fold") == k
        parts += [F.count_if(here).alias(f"n{k}"), F.sum(F.when(here, F.col("y")).otherwise(0.0)).alias(f"s{k}"), F.sum(F.when(here, F.col("y") * F.col("y")).otherwise(0.0)).alias(f"q{k}")]
    bins = rows.groupBy("feature", "bin").agg(*parts)
    names = [f"{x}{k}" for k in range(FOLDS) for x in "nsq"]
    totals = bins.groupBy("feature").agg(*[F.sum(c).alias(f"all_{c}") for c in names])

    def others(prefix: str, x: str, k: int) -> Column:
        return sum(F.col(f"{prefix}{x}{o}") for o in range(FOLDS) if o != k)

    def error(p: Column, k: int) -> Column:
        return F.col(f"q{k}") - 2 * p * F.col(f"s{k}") + p * p * F.col(f"n{k}")

    model = naive = F.lit(0.0)
    for k in range(FOLDS):
        whole = others("all_", "s", k) / F.when(others("all_", "n", k) > 0, others("all_", "n", k))
        own = others("", "s", k) / F.when(others("", "n", k) > 0, others("", "n", k))
        model = model + F.coalesce(error(F.coalesce(own, whole), k), F.lit(0.0))
        naive = naive + F.coalesce(error(whole, k), F.lit(0.0))
    sums = bins.join(F.broadcast(totals), "feature").groupBy("feature").agg(F.sum(model).alias("model"), F.sum(naive).alias("naive"))
    share = 1 - F.col("model") / F.when(F.col("naive") > 1e-9, F.col("naive"))
    return sums.select("feature", F.greatest(share, F.lit(0.0)).alias("value"))


def integrity_suite(df: DataFrame, label: str, key: Sequence[str], min_rows: int = 50) -> DataFrame:
    """All checks of one table. ``key`` columns are identifiers: they should not foretell the label."""
    strings = [c for c, kind in df.dtypes if kind == "string" and c != label]
    features = [c for c in df.columns if c != label]
    found = []
    if strings:
        found += [string_checks(df, strings), string_mismatch(df, strings), length_outliers(df, strings)]
    power = predictive_power(df, label, features, key)
    check = F.when(F.col("feature").isin(*key), "identifier_label").otherwise("predictive_power")
    found.append(power.select(check.alias("check"), F.col("feature").alias("column"), "value"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    limit = F.create_map(*[F.lit(x) for kv in LIMITS.items() for x in kv])
    low, high = RARE_TYPE
    mixed = (F.col("value") > low) & (F.col("value") < high)
    bad = F.when(F.col("check") == "mixed_types", mixed).otherwise(F.col("value") > F.try_element_at(limit, F.col("check")))
    few = df.agg(F.count(F.lit(1)) < min_rows).scalar()
    return out.withColumn("status", F.when(few, "skipped").when(bad, "failed").otherwise("passed"))
