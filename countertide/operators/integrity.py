"""Data checks before training, as a table of (check, column, value, passed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countertide.operators.stats import correlation_matrix

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _line(check: str, column: str, value: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        value.cast("double").alias("value"),
        F.coalesce(passed, F.lit(True)).alias("passed"),
    )


def integrity_report(
    df: DataFrame,
    label: str | None = None,
    max_null_share: float = 0.05,
    max_duplicate_share: float = 0.0,
    max_conflict_share: float = 0.0,
    max_correlation: float = 0.95,
    min_rows: int = 50,
) -> DataFrame:
    """Null share, constant columns, duplicates, conflicting labels, and too high correlation.

    Null shares and constants come from one pass. Duplicates and conflicts come from counts per
    distinct row, so that many copies of one row are combined before the shuffle. Tables below
    ``min_rows`` are not judged: every check but the row count passes.
    """
    cols = df.columns
    numbers = [c for c, kind in df.dtypes if kind in _NUMERIC]
    features = [c for c in cols if c != label]
    pairs = [(a, b) for i, a in enumerate(numbers) for b in numbers[i + 1 :]]

    wide = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(c).alias(f"count_{c}") for c in cols],
        *[(F.min(c) == F.max(c)).alias(f"constant_{c}") for c in cols],
    )
    correlations = correlation_matrix(df, numbers) if pairs else None
    distinct = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    duplicates = distinct.agg(F.sum(F.col("_copies") - 1)).scalar()
    conflicts = F.lit(0)
    if label:
        conflicts = (
            distinct.groupBy(*features)
            .agg((F.count(F.lit(1)) > 1).alias("_split"), F.sum("_copies").alias("_rows"))
            .agg(F.sum(F.when(F.col("_split"), F.col("_rows")).otherwise(0)))
            .scalar()
        )

    n = F.col("n")
    share = {c: (n - F.col(f"count_{c}")) / F.when(n > 0, n) for c in cols}
    duplicate_share = F.col("_duplicates") / F.when(n > 0, n)
    conflict_share = F.col("_conflicts") / F.when(n > 0, n)
    lines = [_line("rows", "*", n, n >= min_rows)]
    lines += [_line("null_share", c, share[c], share[c] <= max_null_share) for c in cols]
    lines += [
        _line("constant", c, F.coalesce(F.col(f"constant_{c}"), F.lit(True)).cast("int"), ~F.coalesce(F.col(f"constant_{c}"), F.lit(True)))
        for c in cols
    ]
    lines.append(_line("duplicate_share", "*", duplicate_share, duplicate_share <= max_duplicate_share))
    if label:
        lines.append(_line("conflict_share", label, conflict_share, conflict_share <= max_conflict_share))
    known = wide.withColumns({"_duplicates": duplicates, "_conflicts": conflicts})
    report = known.select(F.inline(F.array(*lines)))
    if correlations is not None:
        named = {c: i for i, c in enumerate(numbers)}
        place = F.create_map(*[F.lit(x) for kv in named.items() for x in kv])
        high = F.coalesce(F.abs("corr") <= max_correlation, F.lit(True))
        report = report.unionByName(
            correlations.filter(place[F.col("a")] < place[F.col("b")]).select(
                F.lit("correlation").alias("check"),
                F.concat_ws("~", "a", "b").alias("column"),
                F.col("corr").alias("value"),
                high.alias("passed"),
            )
        )
    rows = df.agg(F.count(F.lit(1))).scalar()
    return report.withColumn("passed", F.col("passed") | ((rows < min_rows) & (F.col("check") != "rows")))
