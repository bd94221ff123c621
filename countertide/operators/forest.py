"""Isolation forest (Liu, Ting, Zhou: Isolation Forest, 2008).

Each tree sees a small random sample, so trees are built independently, one group per tree, and
the finished forest is a table of bounded size that is broadcast for scoring.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countertide.plans.ordered import exact_quantile

SAMPLE_SIZE = 256
TREES = 200
CONTAMINATION = 0.01
EULER_GAMMA = 0.5772156649015329


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Average path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 2.0)
    long = 2.0 * (np.log(big - 1.0) + EULER_GAMMA) - 2.0 * (big - 1.0) / big
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, long))


def tree_samples(df: DataFrame, key: str, trees: int, size: int, seed: int) -> DataFrame:
    """``size`` rows for each tree, the same ones on every run.

    First a pool of ``trees * size`` rows in hash order over the whole table (a distributed top-k),
    then the rows of each tree in an order hashed per tree. Both steps are bounded.
    """
    pool = df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(trees * size)
    dealt = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    drawn = Window.partitionBy("tree").orderBy(F.xxhash64(F.lit(seed), "tree", key), key)
    return dealt.withColumn("_place", F.row_number().over(drawn)).filter(F.col("_place") <= size).drop("_place")


def _grow(points: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes as (id, feature, split, left, right, length); leaves have feature -1."""
    nodes: list[tuple] = []
    waiting = [(0, points, 0)]
    next_id = 1
    while waiting:
        node, rows, depth = waiting.pop()
        spread = rows.max(axis=0) > rows.min(axis=0) if len(rows) else np.zeros(points.shape[1], bool)
        if depth >= limit or len(rows) <= 1 or not spread.any():
            nodes.append((node, -1, 0.0, -1, -1, depth + float(expected_path(len(rows)))))
            continue
        feature = int(rng.choice(np.flatnonzero(spread)))
        low, high = rows[:, feature].min(), rows[:, feature].max()
        split = float(rng.uniform(low, high))
        goes_left = rows[:, feature] <= split
        if goes_left.all():  # the draw hit the upper end
            goes_left = rows[:, feature] < high
        left, right = next_id, next_id + 1
        next_id += 2
        nodes.append((node, feature, split, left, right, 0.0))
        waiting += [(left, rows[goes_left], depth + 1), (right, rows[~goes_left], depth + 1)]
    return nodes


@dataclass
class IsolationForest:
    """A fitted forest: node tables per tree, the sample size, and the score below which rows are anomalies."""

    features: tuple[str, ...]
    nodes: list[np.ndarray]
    sample_size: int
    offset: float

    def score(self, df: DataFrame, out: str = "score", flag: str = "is_anomaly") -> DataFrame:
        """Normality minus the offset: below 0 is an anomaly."""
        raw = raw_scores(df, self.features, self.nodes, self.sample_size, "_raw")
        return (
            raw.withColumn(out, F.col("_raw") - F.lit(self.offset))
            .withColumn(flag, F.col(out) < 0)
            .drop("_raw")
        )

    def feature_importance(self) -> dict[str, float]:
        """The method has no importances; every input counts the same."""
        return {f: 1.0 for f in self.features}


def raw_scores(
    df: DataFrame, features: Sequence[str], nodes: list[np.ndarray], sample_size: int, out: str
) -> DataFrame:
    """Minus the anomaly score of the paper, in [-1, 0]; whole batches walk each tree together."""
    shared = df.sparkSession.sparkContext.broadcast(nodes)
    norm = float(expected_path(sample_size)) or 1.0

    @F.pandas_udf("double")
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        forest = shared.value
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            rows = np.arange(len(x))
            length = np.zeros(len(x))
            for tree in forest:
                at = np.zeros(len(x), dtype=np.int64)
                feature = tree["feature"]
                moving = feature[at] >= 0
                while moving.any():
                    here = at[moving]
                    left = x[rows[moving], feature[here]] <= tree["split"][here]
                    at[moving] = np.where(left, tree["left"][here], tree["right"][here])
                    moving = feature[at] >= 0
                length += tree["length"][at]
            yield pd.Series(-np.power(2.0, -length / len(forest) / norm))

    return df.withColumn(out, walk(F.struct(*[F.col(f).cast("double").alias(f) for f in features])))


NODE_SCHEMA = "tree int, node int, feature int, split double, left int, right int, length double"
NODE_TYPE = [("feature", "i4"), ("split", "f8"), ("left", "i4"), ("right", "i4"), ("length", "f8")]


def fit_isolation_forest(
    df: DataFrame,
    features: Sequence[str],
    key: str = "video_id",
    trees: int = TREES,
    sample_size: int = SAMPLE_SIZE,
    contamination: float = CONTAMINATION,
    seed: int = 42,
) -> IsolationForest:
    """Grow the trees in parallel, then set the offset to the ``contamination`` quantile of all scores."""
    names = list(features)
    rows = df.select(key, *[F.col(f).cast("double").alias(f) for f in names])
    used = min(sample_size, rows.count())
    if used == 0:
        raise ValueError("no rows to fit on")
    limit = max(1, math.ceil(math.log2(max(used, 2))))

    def build(sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(sample["tree"].iloc[0])
        points = sample.sort_values(key)[names].to_numpy(dtype=float)
        grown = _grow(points, np.random.default_rng([seed, tree]), limit)
        return pd.DataFrame(
            [(tree, *node) for node in grown],
            columns=["tree", "node", "feature", "split", "left", "right", "length"],
        )

    sampled = tree_samples(rows, key, trees, used, seed)
    # At most trees * (2 * sample_size - 1) nodes, whatever the table holds.
    table = sampled.groupBy("tree").applyInPandas(build, NODE_SCHEMA).toPandas()
    nodes = []
    for _, part in table.sort_values(["tree", "node"]).groupby("tree"):
        tree = np.zeros(len(part), dtype=NODE_TYPE)
        for name, _kind in NODE_TYPE:
            tree[name] = part[name].to_numpy()
        nodes.append(tree)
    scored = raw_scores(rows, names, nodes, used, "_raw").select("_raw")
    offset = exact_quantile(scored, "_raw", contamination).first()[0]
    return IsolationForest(tuple(names), nodes, used, float(offset))
