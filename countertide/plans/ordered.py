"""Order-dependent computations without a single-task window.

A window that is ordered over a whole table, or over one hot key, runs in one task. Here the
rows are cut into range slices of about equal size instead (a hot key spans many slices), each
slice is processed on its own, and what has to cross a slice border is a table of at most a
few rows per slice. ``order`` must be unique within ``keys``; then every slice is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countertide.plans.shared import freeze

SLICE = "_slice"


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Null-safe equi join with the small border table ``right``."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    match = F.lit(True)
    for c in cols:
        match = match & left[c].eqNullSafe(renamed[f"_r_{c}"])
    joined = left.join(F.broadcast(renamed), match, how)
    return joined if how == "left_semi" else joined.drop(*[f"_r_{c}" for c in cols])


def range_slices(df: DataFrame, order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Number the range partitions of ``df`` and freeze them.

    The slice number must not change between the passes that use it: another execution could
    sample other range borders, so the numbered rows are written down once.
    """
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return freeze(df.repartitionByRange(n, *order).withColumn(SLICE, F.spark_partition_id()), "slices")


def _border_keys(cut: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur in more than one slice.

    The rows are in range order, so at most one key crosses the border between two neighbouring
    slices: the result has fewer rows than there are slices and may always be broadcast.
    """
    extent = cut.groupBy(*keys).agg(F.min(SLICE).alias("_low"), F.max(SLICE).alias("_high"))
    return extent.filter("_low < _high").select(*keys)


def carry_in(cut: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Per (border key, slice): the sums over all earlier slices; at most two rows per slice, so always small."""
    rows = _same(cut, _border_keys(cut, keys), keys, "left_semi") if keys else cut
    per_slice = rows.groupBy(*keys, SLICE).agg(*[F.sum(m).alias(m) for m in measures])
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return per_slice.select(*keys, SLICE, *[F.sum(m).over(before).alias(f"_carry_{m}") for m in measures])


def running_totals_of_slices(
    cut: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Sequence[str], prefix: str = "cum_"
) -> DataFrame:
    """Inclusive running sums of ``measures`` over sliced rows."""
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.select("*", *[F.sum(m).over(inside).alias(f"_local_{m}") for m in measures])
    carried = _same(local, carry_in(cut, keys, measures), [*keys, SLICE], "left")
    kept = [c for c in cut.columns if c != SLICE]
    return carried.select(
        *kept,
        *[(F.col(f"_local_{m}") + F.coalesce(f"_carry_{m}", F.lit(0))).alias(f"{prefix}{m}") for m in measures],
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Sequence[str],
    prefix: str = "cum_",
    slices: int | None = None,
) -> DataFrame:
    """Inclusive running sums per ``keys`` in ``order``, whatever the share of the largest key."""
    return running_totals_of_slices(range_slices(df, [*keys, *order], slices), keys, order, measures, prefix)


def mean_of_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    n: int,
    out: str,
    slices: int | None = None,
) -> DataFrame:
    """Mean of ``value`` over the ``n`` rows before each row of its key; null for the first row.

    Only the first ``n`` rows of a slice can need rows of an earlier slice. For border keys the
    first and last ``n`` rows of each slice form a small table in which the frame is complete
    for those rows; their means replace the slice-local ones.
    """
    cut = range_slices(df, [*keys, *order], slices)
    place = Window.partitionBy(*keys, SLICE).orderBy(*order)
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-n, -1)
    one = F.lit(1)
    near_border = (
        _same(cut, _border_keys(cut, keys), keys, "left_semi")
        .select(
            *keys,
            *order,
            value,
            F.lag(one, n).over(place).isNull().alias("_head"),
            F.lead(one, n).over(place).isNull().alias("_tail"),
        )
        .filter("_head or _tail")
    )
    corrected = (
        near_border.select(*keys, *order, "_head", F.avg(value).over(before).alias("_mean"))
        .filter("_head")
        .withColumn("_fixed", F.lit(True))
        .drop("_head")
    )
    local = cut.withColumn("_local", F.avg(value).over(place.rowsBetween(-n, -1)))
    kept = [c for c in cut.columns if c != SLICE]
    return _same(local, corrected, [*keys, *order], "left").select(
        *kept, F.when(F.col("_fixed"), F.col("_mean")).otherwise(F.col("_local")).alias(out)
    )


def exact_quantile(df: DataFrame, value: str, q: float, out: str = "threshold") -> DataFrame:
    """One row: the ``q`` quantile with linear interpolation, equal to an exact percentile.

    Rows are first reduced to counts per distinct value (partial aggregation), then the values
    holding the two neighbouring ranks are found by running counts over range slices.
    """
    counts = (
        df.select(F.col(value).cast("double").alias("v"))
        .filter(F.col("v").isNotNull() & ~F.isnan("v"))
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cut = range_slices(counts, ["v"])
    ranked = running_totals_of_slices(cut, [], ["v"], ["n"])
    total = cut.agg(F.sum("n")).scalar()
    placed = ranked.select("v", "cum_n", (F.lit(float(q)) * (total - 1)).alias("rank"))
    picked = placed.agg(
        F.min(F.when(F.col("cum_n") > F.floor("rank"), F.col("v"))).alias("low"),
        F.min(F.when(F.col("cum_n") > F.ceil("rank"), F.col("v"))).alias("high"),
        F.max(F.col("rank") - F.floor("rank")).alias("part"),
    )
    return picked.select((F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias(out))
