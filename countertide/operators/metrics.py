"""Evaluation metrics as one-row (or one row per group) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countertide.functions import numeric

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(0.0)


def _label(df: DataFrame, name: str, rounded: bool = False) -> Column:
    """A label in comparable text form; numbers go through double so that 1 and 1.0 agree."""
    if dict(df.dtypes)[name] not in _NUMERIC:
        return F.col(name).cast("string")
    value = F.col(name).cast("double")
    return (F.rint(value) if rounded else value).cast("string")


def _per_label(df: DataFrame, y: Column, p: Column, by: Sequence[str]) -> DataFrame:
    """Support, predictions and hits per label; after the first aggregation only label pairs remain."""
    pairs = df.groupBy(*by, y.alias("y"), p.alias("p")).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("bigint")
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(none)
    sides = F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("support"), none.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("p").alias("label"), none.alias("support"), F.col("n").alias("predicted"), none.alias("hits")),
    )
    return (
        pairs.select(*by, F.inline(sides))
        .groupBy(*by, "label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )


def _summary(per_label: DataFrame, by: Sequence[str], positive: str, binary: Column) -> DataFrame:
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    rated = per_label.withColumns(
        {
            "precision": precision,
            "recall": recall,
            "f1": _ratio(2.0 * F.col("hits"), F.col("support") + F.col("predicted")),
        }
    )
    n = F.sum("support")

    def pick(name: str) -> Column:
        of_positive = F.coalesce(F.max(F.when(F.col("label") == positive, F.col(name))), F.lit(0.0))
        weighted = F.sum(F.col("support") * F.col(name)) / n
        return F.when(binary, of_positive).otherwise(weighted).alias(name)

    return rated.groupBy(*by).agg(
        (F.sum("hits") / n).alias("accuracy"), pick("f1"), pick("precision"), pick("recall")
    )


def classification_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = (), positive: float | str = 1) -> DataFrame:
    """Accuracy, f1, precision, recall: of the positive class with two true labels, else weighted by support."""
    wanted = str(float(positive)) if dict(df.dtypes)[y] in _NUMERIC else str(positive)
    labels = _per_label(df, _label(df, y), _label(df, p), by)
    two = F.count(F.when(F.col("support") > 0, 1)) == 2
    return _summary(labels, by, wanted, two)


def evaluate_classification(
    df: DataFrame, y: str, p: str, task: str = "classification", by: Sequence[str] = ()
) -> DataFrame:
    """Like :func:`classification_metrics`, but predictions are rounded half to even and ``task`` picks the average."""
    wanted = "1.0" if dict(df.dtypes)[y] in _NUMERIC else "1"
    labels = _per_label(df, _label(df, y), _label(df, p, rounded=True), by)
    return _summary(labels, by, wanted, F.lit(task == "binary"))


def _regression(y: Column, p: Column, prefix: str = "") -> list[Column]:
    miss = y - p
    rest = F.sum(miss * miss)
    spread = F.var_pop(y) * F.count(y)
    r2 = F.when(spread > 0, 1 - rest / F.when(spread > 0, spread)).when(rest == 0, 1.0).otherwise(0.0)
    return [
        F.avg(F.abs(miss)).alias(f"{prefix}mae"),
        F.sqrt(F.avg(miss * miss)).alias(f"{prefix}rmse"),
        r2.alias(f"{prefix}r2"),
        (F.avg(F.abs(miss / F.when(y == 0, 1.0).otherwise(y))) * 100).alias(f"{prefix}mape_percent"),
    ]


def regression_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """mae, rmse, r2 and mape in percent (a true 0 divides by 1), in one aggregation."""
    return df.groupBy(*by).agg(*_regression(F.col(y).cast("double"), F.col(p).cast("double")))


def log_and_real_metrics(df: DataFrame, y: str, log_prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Regression metrics in real space and, with the prefix ``log_``, in log space of bounded predictions."""
    true, bounded = F.col(y).cast("double"), numeric.bounded_log(F.col(log_prediction))
    return df.groupBy(*by).agg(*_regression(true, F.expm1(bounded)), *_regression(F.log1p(true), bounded, "log_"))


def masked_mape(df: DataFrame, y: str, p: str) -> DataFrame:
    """Percentage error over rows whose true value is not 0; the divisor keeps its sign."""
    true = F.col(y).cast("double")
    error = F.when(true != 0, F.abs(true - F.col(p)) / F.when(true != 0, true))
    return df.agg((F.avg(error) * 100).alias("mape"))


def topk_accuracy(df: DataFrame, y: str, probabilities: str, k: int = 3) -> DataFrame:
    """Share of rows whose true class index is among the ``k`` most probable; ties favour the larger index."""
    own = F.struct(F.element_at(probabilities, F.col(y).cast("int") + 1).alias("p"), F.col(y).cast("int").alias("i"))
    ranked = F.transform(probabilities, lambda x, i: F.struct(x.alias("p"), i.alias("i")))
    ahead = F.size(F.filter(ranked, lambda s: s > own))
    return df.agg(F.avg((ahead < k).cast("double")).alias("topk_accuracy"))


def rule_metrics(rules: DataFrame) -> DataFrame:
    """Count, average lift and confidence, highest lift; zeros when there are no rules."""
    zero = F.lit(0.0)
    return rules.agg(
        F.count(F.lit(1)).alias("rule_count"),
        F.coalesce(F.avg("lift"), zero).alias("avg_lift"),
        F.coalesce(F.avg("confidence"), zero).alias("avg_confidence"),
        F.coalesce(F.max("lift"), zero).alias("max_lift"),
    )


def confusion_matrix(df: DataFrame, y: str, p: str, labels: Sequence[object] = (0, 1)) -> DataFrame:
    """Counts for every pair of the given labels, zero cells included."""
    listed = F.array(*[F.lit(v) for v in labels])
    counts = df.groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    grid = (
        df.sparkSession.range(1)
        .select(F.explode(listed).alias("actual"))
        .select("actual", F.explode(listed).alias("predicted"))
    )
    return grid.join(counts, ["actual", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def anomaly_summary(scored: DataFrame, score: str = "score", flag: str = "is_anomaly") -> DataFrame:
    """How many rows were flagged, their share, and the mean and lowest score."""
    flagged = F.sum(F.col(flag).cast("bigint"))
    return scored.agg(
        flagged.alias("n_anomalies"),
        F.round(flagged / F.count(F.lit(1)), 4).alias("detected_rate"),
        F.round(F.avg(score), 4).alias("avg_normality_score"),
        F.round(F.min(score), 4).alias("most_anomalous_score"),
    )


def label_share(df: DataFrame, label: str) -> DataFrame:
    positives = F.sum(F.col(label).cast("bigint"))
    return df.agg(positives.alias("positives"), (100.0 * positives / F.count(F.lit(1))).alias("percent"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive, the weight of the positive class; 1 when there are no positives."""
    negatives, positives = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return df.agg(
        negatives.alias("negatives"),
        positives.alias("positives"),
        F.when(positives > 0, negatives / positives).otherwise(1.0).alias("scale_pos_weight"),
    )
