"""Training and scoring of the supervised models over whole tables."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countertide.functions import numeric
from countertide.functions.calendar import cyclic_hour
from countertide.functions.text import UPPERCASE_CLASS, clean_text, strip, title_features
from countertide.operators import features as feats
from countertide.operators import boosting, metrics, vectors
from countertide.plans.shared import freeze, frozen_while

# Search spaces and layer sizes.
CLICKBAIT_SEARCH = {"maxIter": (50, 100, 200), "maxDepth": (5, 10, 20), "minInstancesPerNode": (2, 5, 10)}
VIRAL_INVERSE_STRENGTH = (0.01, 0.1, 1.0, 10.0)
SVD_CANDIDATES = (50, 100, 200, 300)
HIDDEN_LAYERS = (256, 128)
TOLERANCE = 1e-4  # where logistic regression stops; each further step would be a pass over the rows
EPOCHS = 20


def is_test_row(key: Column, share: float = 0.2, seed: int = 42) -> Column:
    """Deterministic split by a hash of the key: it survives repartitioning and lost executors.

    The default seed leaves the key as it is, so other engines can repeat the split.
    """
    salted = key.cast("string") if seed == 42 else F.concat_ws("|", F.lit(seed), key.cast("string"))
    parts = max(2, round(1 / share))
    number = F.conv(F.substring(F.md5(salted), 1, 8), 16, 10).cast("bigint")
    return number % parts == 0


def split(df: DataFrame, key: Sequence[str] = ("video_id",), share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split``: train or test."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    return df.withColumn("split", F.when(is_test_row(text, share, seed), "test").otherwise("train"))


def train_part(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "train")


def test_part(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "test")


def check_inputs(df: DataFrame, names: Sequence[str]) -> None:
    """Refuse a table that lacks model inputs."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing inputs: {', '.join(missing)}")


def assembled(df: DataFrame, names: Sequence[str], out: str = "features") -> DataFrame:
    check_inputs(df, names)
    return VectorAssembler(inputCols=list(names), outputCol=out, handleInvalid="keep").transform(df)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight of each row: rows / (classes * rows of its class). The class table is one row per class."""
    per_class = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    share = per_class.agg(F.sum("_n") / F.count(F.lit(1))).scalar()
    weights = per_class.select(label, (share / F.col("_n")).alias(out))
    return df.join(F.broadcast(weights), label)


def with_folds(df: DataFrame, key: Sequence[str], folds: int, out: str = "_fold") -> DataFrame:
    """A fold number per row from a hash of its key, the same on every run and after lost executors."""
    return df.withColumn(out, F.pmod(F.xxhash64(F.lit("fold"), *key), F.lit(folds)).cast("int"))


class PositiveF1(Evaluator):
    """f1 of class 1 in one aggregation; 0 when a fold has no such rows, where Spark's own evaluator fails."""

    def __init__(self, label: str = "_label", prediction: str = "prediction"):
        super().__init__()
        self.label, self.prediction = label, prediction

    def _evaluate(self, dataset: DataFrame) -> float:
        true, guess = F.col(self.label) == 1.0, F.col(self.prediction) == 1.0
        both = dataset.agg(2.0 * F.count_if(true & guess), F.count_if(true) + F.count_if(guess)).first()
        return both[0] / both[1] if both[1] else 0.0


@dataclass
class Trained:
    """A fitted model, the inputs it expects, and its rows with split and prediction."""

    model: object
    features: tuple[str, ...]
    scored: DataFrame
    metrics: DataFrame


# ---------------------------------------------------------------- velocity


def train_velocity(
    features: DataFrame,
    target: str = "views",
    trees: int = 2000,
    depth: int = 6,
    rate: float = 0.02,
    leaf_penalty: float = 5.0,
    loss: str = "huber",
    key: Sequence[str] = ("video_id",),
    block_rows: int = boosting.BLOCK_ROWS,
) -> Trained:
    """Boosted symmetric trees on the log of the target, Huber loss of width 1; the category by ordered target means."""
    names = tuple(c for c in feats.VELOCITY_FEATURES if c in features.columns)
    rows = freeze(split(features, key).withColumn("_log_target", F.log1p(F.col(target).cast("double"))), "velocity")
    setting = boosting.Setting(trees, depth, rate, leaf_penalty, 1, loss, symmetric=True)
    category = "category_id" if "category_id" in names else None
    model = boosting.fit_boosted(
        train_part(rows).filter(F.col("_log_target").isNotNull()), names, "_log_target", [setting], category=category, key=key, block_rows=block_rows
    )[0]
    scored = model.transform(rows, "log_prediction")
    return Trained(model, names, scored, metrics.log_and_real_metrics(scored, target, "log_prediction", by=["split"]))


def score_velocity(trained: Trained, df: DataFrame, key: str = "video_id") -> DataFrame:
    """Whole views, never below 0. Rows that cannot be scored get null and a reason."""
    check_inputs(df, trained.features)
    complete = F.lit(True)
    for name in trained.features:
        complete = complete & F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))
    filled = df.withColumn("_complete", complete).fillna(0, subset=list(trained.features))
    raw = trained.model.transform(filled, "log_prediction")
    views = F.floor(F.greatest(F.expm1("log_prediction"), F.lit(0.0))).cast("bigint")
    return raw.select(
        key,
        F.when(F.col("_complete"), views).alias("prediction"),
        F.when(~F.col("_complete"), "missing_input").alias("reason"),
    )


# ---------------------------------------------------------------- clickbait


def sampled_grid(space: Mapping[str, Sequence[object]], n: int, seed: int = 42) -> list[dict[str, object]]:
    """``n`` distinct settings of a search space in a seeded random order."""
    grid: list[dict[str, object]] = [{}]
    for name, values in space.items():
        grid = [{**g, name: v} for g in grid for v in values]
    random.Random(seed).shuffle(grid)
    return grid[:n]


def train_clickbait(
    features: DataFrame,
    label: str = "is_clickbait",
    space: Mapping[str, Sequence[object]] = CLICKBAIT_SEARCH,
    n_settings: int = 20,
    folds: int = 3,
    rate: float = 0.3,
    block_rows: int = boosting.BLOCK_ROWS,
) -> Trained:
    """Boosted trees with a weighted positive class; settings are drawn at random and compared by f1.

    All settings and folds are fitted in the same passes; a fold is a mask, and its f1 is counted where the rows lie, so that
    the driver holds the trees of the chosen setting only. Feature rows are distinct, so the row itself
    is the key of the split. The best mean f1 over folds wins, of equal ones the setting drawn first.
    """
    names = tuple(c for c in feats.CLICKBAIT_FEATURES if c in features.columns)
    marked = freeze(split(features, key=names), "clickbait")
    balance = metrics.class_balance(train_part(marked), label).select("scale_pos_weight").scalar()
    weighted = marked.withColumn("weight", F.when(F.col(label) == 1, balance).otherwise(1.0))
    ready = freeze(with_folds(weighted.withColumn("_label", F.col(label).cast("double")), names, folds), "clickbait-folds")
    grid = sampled_grid(space, n_settings)

    def setting(g: Mapping[str, object], fold: int) -> boosting.Setting:
        return boosting.Setting(int(g["maxIter"]), int(g["maxDepth"]), rate, 1.0, int(g.get("minInstancesPerNode", 1)), "logistic", fold=fold)

    train = train_part(ready)
    tried = [(g, fold) for g in range(len(grid)) for fold in range(folds)]
    search = boosting.prepare(train, names, "_label", "logistic", weight="weight", fold="_fold", block_rows=block_rows)
    scores = [0.0] * len(grid)
    for (g, _), f1 in zip(tried, search.held_out_f1([setting(grid[g], fold) for g, fold in tried])):
        scores[g] += f1 / folds
    chosen = setting(grid[int(np.argmax(scores))], -1)
    best = boosting.fit_boosted(train, names, "_label", [chosen], weight="weight", block_rows=block_rows)[0]
    scored = best.transform(ready)
    result = metrics.classification_metrics(scored, label, "prediction", by=["split"])
    return Trained(best, names, scored, result)


def held_out_f1(train: DataFrame, fits: Sequence[boosting.Boosted], folds: Sequence[int], label: str = "_label") -> list[float]:
    """f1 of class 1 of each fit on the fold that it left out, all in one pass; 0 without such rows."""
    scored = boosting.margins(train, fits)
    terms = []
    for k, fold in enumerate(folds):
        here, guess, true = F.col("_fold") == fold, F.col("_margins")[k] > 0, F.col(label) == 1.0
        terms += [2.0 * F.count_if(here & guess & true), F.count_if(here & guess) + F.count_if(here & true)]
    row = scored.agg(F.array(*[t.cast("double") for t in terms])).head()[0]
    return [a / b if b else 0.0 for a, b in zip(row[::2], row[1::2])]


def clickbait_request_features(df: DataFrame, uppercase: str = UPPERCASE_CLASS) -> DataFrame:
    """Serving inputs from title, hour, day and weekend flag: the title is trimmed and the times are clamped."""
    clamp = lambda name, top: F.greatest(F.least(F.coalesce(F.col(name), F.lit(0)), F.lit(top)), F.lit(0))
    title = title_features(strip(F.coalesce("title", F.lit(""))), uppercase)
    hour = cyclic_hour(clamp("publish_hour", 23))
    return df.withColumns(
        {
            **{n: title[n] for n in ("title_len", "caps_ratio", "exclamation_count", "question_count", "has_digits")},
            **hour,
            "publish_day": clamp("publish_day", 6),
            "is_weekend": (F.coalesce(F.col("is_weekend"), F.lit(0)) != 0).cast("int"),
        }
    )


def _binary_scores(trained: Trained, df: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    check_inputs(df, trained.features)
    ready = df if isinstance(trained.model, boosting.Boosted) else assembled(df, trained.features)
    return trained.model.transform(ready).select(
        key,
        F.when(F.col("prediction") == 1.0, names[1]).otherwise(names[0]).alias("label"),
        vector_to_array("probability")[1].alias("probability"),
    )


def score_clickbait(trained: Trained, df: DataFrame, key: str = "video_id") -> DataFrame:
    """Label and probability; ``df`` holds title, publish_hour, publish_day and is_weekend."""
    return _binary_scores(trained, clickbait_request_features(df), key, ("Solid", "Clickbait"))


# ---------------------------------------------------------------- viral


def train_viral(
    matrix: DataFrame,
    label: str = "is_viral",
    inverse_strength: Sequence[float] = VIRAL_INVERSE_STRENGTH,
    folds: int = 3,
    max_iter: int = 1000,
    parallelism: int = 2,
) -> Trained:
    """Balanced logistic regression on raw inputs, its strength chosen by f1.

    ``1 / (C * rows)`` gives Spark's mean loss the balance that ``C`` gives to a summed loss.
    """
    names = tuple(c for c in feats.VIRAL_FEATURES if c in matrix.columns)
    marked = freeze(split(matrix), "viral-train")
    train = assembled(balanced_weights(train_part(marked), label), names).withColumn("_label", F.col(label).cast("double"))
    train = train.cache()
    rows = train.count()
    plain = LogisticRegression(
        featuresCol="features", labelCol="_label", weightCol="weight", maxIter=max_iter, tol=TOLERANCE,
        standardization=False,
    )
    grid = [{plain.regParam: 1.0 / (c * rows * (folds - 1) / folds)} for c in inverse_strength]
    search = CrossValidator(
        estimator=plain, estimatorParamMaps=grid, evaluator=PositiveF1(), numFolds=folds, foldCol="_fold",
        parallelism=parallelism,
    ).fit(with_folds(train, ["video_id"], folds))
    best_c = inverse_strength[int(np.argmax(search.avgMetrics))]
    model = plain.copy({plain.regParam: 1.0 / (best_c * rows)}).fit(train)
    train.unpersist()
    scored = model.transform(assembled(marked, names))
    return Trained(model, names, scored, metrics.classification_metrics(scored, label, "prediction", by=["split"]))


def viral_request_features(df: DataFrame) -> DataFrame:
    """Serving inputs: start views from their log; tracking time and snapshot count are fixed."""
    return df.withColumns(
        {"start_views": F.expm1("log_start_views"), "hours_tracked": F.lit(2.0), "snapshots": F.lit(2)}
    )


def score_viral(trained: Trained, df: DataFrame, key: str = "video_id") -> DataFrame:
    return _binary_scores(trained, viral_request_features(df), key, ("Not Viral", "Viral"))


# ---------------------------------------------------------------- genre


@dataclass
class GenreModel:
    """Vectorizer, SVD basis, label indexer and network, in the order they are applied."""

    vectorizer: PipelineModel
    basis: np.ndarray
    labels: StringIndexerModel
    network: object

    def transform(self, corpus: DataFrame) -> DataFrame:
        reduced = vectors.project(vectors.text_vectors(self.vectorizer, corpus), "tfidf", self.basis)
        named = IndexToString(inputCol="prediction", outputCol="predicted_genre", labels=self.labels.labels)
        return named.transform(self.network.transform(reduced))


def _prefix(df: DataFrame, col: str, k: int, out: str) -> DataFrame:
    from pyspark.ml.feature import VectorSlicer

    return VectorSlicer(inputCol=col, outputCol=out, indices=list(range(k))).transform(df)


def choose_svd_k(
    vectors_df: DataFrame,
    label: str,
    candidates: Sequence[int] = SVD_CANDIDATES,
    key: Sequence[str] = ("video_id",),
    col: str = "tfidf",
    min_rows: int = 200,
) -> DataFrame:
    """(k, accuracy) per candidate on an inner split, by balanced logistic regression.

    The basis is fitted once for the largest candidate; smaller ones are its leading columns.
    Returns no rows when the table is too small or no candidate fits the vocabulary.
    """
    spark = vectors_df.sparkSession
    empty = spark.createDataFrame([], "k int, accuracy double")
    rows = vectors_df.count()
    width = vectors_df.select(F.max(F.unwrap_udt(col)["size"])).first()[0] or 0
    usable = [k for k in candidates if k <= width]
    if rows <= min_rows or not usable:
        return empty
    inner = split(vectors_df, key, seed=43)
    v, _ = vectors.fit_svd(train_part(inner), col, min(max(usable), width))
    results = []
    with frozen_while(vectors.project(inner, col, v, "_all_k").select(label, "split", "_all_k"), "reduced") as reduced:
        for k in sorted(usable):
            data = _prefix(reduced, "_all_k", min(k, v.shape[1]), "features")
            proxy = LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight", maxIter=200, tol=TOLERANCE)
            model = proxy.fit(balanced_weights(train_part(data), label))
            hits = model.transform(test_part(data)).agg(F.avg((F.col(label) == F.col("prediction")).cast("double")))
            results.append((k, hits.first()[0]))
    return spark.createDataFrame(results, "k int, accuracy double")


def train_genre(
    corpus: DataFrame,
    candidates: Sequence[int] = SVD_CANDIDATES,
    hidden: Sequence[int] = HIDDEN_LAYERS,
    epochs: int = EPOCHS,
    key: Sequence[str] = ("video_id",),
) -> Trained:
    """Text weights, SVD, and a feed-forward network; the number of components is chosen first."""
    labels = StringIndexer(inputCol="genre", outputCol="label", stringOrderType="alphabetAsc").fit(corpus)
    marked = freeze(labels.transform(split(corpus, key)), "genre")
    fitted_on = train_part(marked)
    weighted, vectorizer = vectors.fit_text_vectors(fitted_on, key=key[0])
    width = len(vectorizer.stages[0].vocabulary)
    with frozen_while(weighted.select(*key, "label", "tfidf"), "genre_vectors") as train_vectors:
        tried = choose_svd_k(train_vectors, "label", candidates, key)
        best = tried.orderBy(F.desc("accuracy"), "k").first()
        k = min(best["k"] if best else min(candidates), width)
        basis, _ = vectors.fit_svd(train_vectors, "tfidf", k)
        # Written before the fit: each of its jobs sends out the plan behind its rows, and this one holds the basis.
        with frozen_while(vectors.project(train_vectors.select("label", "tfidf"), "tfidf", basis).drop("tfidf"), "reduced") as reduced:
            network = MultilayerPerceptronClassifier(
                featuresCol="reduced", labelCol="label", layers=[basis.shape[1], *hidden, len(labels.labels)],
                maxIter=epochs, blockSize=32, seed=42,
            ).fit(reduced)
    model = GenreModel(vectorizer, basis, labels, network)
    scored = model.transform(marked)
    result = metrics.classification_metrics(scored, "label", "prediction", by=["split"])
    return Trained(model, ("text",), scored, result)


def score_genre(trained: Trained, df: DataFrame, key: str = "video_id") -> DataFrame:
    """Genre and its probability from title and a tag array; cleaning is the same as in training."""
    check_inputs(df, ("title", "tags"))
    whole = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce(F.array_join("tags", " "), F.lit("")))
    corpus = df.select(key, clean_text(whole).alias("text"))
    return trained.model.transform(corpus).select(
        key,
        F.col("predicted_genre").alias("label"),
        F.array_max(vector_to_array("probability")).alias("probability"),
    )


# ---------------------------------------------------------------- shared


def feature_importance(trained: Trained, df: DataFrame) -> DataFrame:
    """(feature, importance): shares of the gains or absolute coefficients. One row per input."""
    model = trained.model
    if isinstance(model, boosting.Boosted):
        weights = model.importances
    else:
        weights = np.abs(model.coefficients.toArray())
    rows = [(n, float(w)) for n, w in zip(trained.features, weights)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy("importance", "feature")


def velocity_predictions_real(scored: DataFrame) -> DataFrame:
    """Add the prediction in real space, from the bounded log prediction."""
    return scored.withColumn("prediction", numeric.from_bounded_log(F.col("log_prediction")))
