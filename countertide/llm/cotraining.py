"""Quality scores by co-training of two views (operator 5).

One classifier sees the text (hashed words, repetition, kinds of characters), the other what comes with the page (host,
language, length, layout of lines). Both start from the same labels. In each round both score all documents without a
label; a document is sure to a view if it lies in the outer ``share`` of that view's scores (found by exact counts over a
fixed grid of scores, equal feature vectors counted once), and either view adds sure documents to the *other's* training
set. On labels held out from training the two scores are calibrated and combined by a logistic model, which then scores
every document from its whole text.

Only what is fitted is bounded: ``labelled`` labelled rows, and ``exchanged`` sure documents of a round and view, both chosen
by hash. Features are made once and written; the rounds read them. Everything else is done for all documents.

Defined results: null or empty texts have no words and are scored like others; rows with null metadata form a value of
their own; a very long text makes a batch of its own and is read whole; labels without text, or null, are not used, of
several labels or texts of an id one is; documents of one cell of the grid are equally sure, among them a hash decides;
what one view calls good and the other bad is exchanged by neither; with labels of one class alone all scores are that
class's share; repeated rows are scored each; columns that bear the name of a result are replaced, all others but text,
host and language kept; empty tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countertide.llm.common import sized, slices, table
from countertide.llm.registry import query
from countertide.llm.textarrays import Words, flat_bytes
from countertide.plans.shared import freeze

WORD_BUCKETS, HOST_BUCKETS, LANGUAGE_BUCKETS = 256, 32, 16
#: Cells of the grid on which scores are counted, for one unit of the linear score; scores beyond the reach lie in the last.
CELLS, REACH = 1000, 30
RESULTS = ("p_content", "p_metadata", "score", "kept")
SYMBOLS = b"#*$%&|<>!?@="  # fixed values: characters that are counted by themselves


@dataclass(frozen=True)
class Training:
    labelled: int = 4000  # labelled rows that are fitted, at most
    exchanged: int = 200  # unlabelled rows that a view passes on in a round, at most
    rounds: int = 4
    share: float = 0.05  # of all unlabelled rows, sure to a view
    steps: int = 150
    penalty: float = 1e-3


def _counts(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def features(texts: pa.Array, hosts: pa.Array, languages: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(content, metadata), one row for each text; all entries lie roughly between -3 and 3."""
    n = len(texts)
    data, offsets = flat_bytes(texts)
    words = Words(texts)
    n_words = np.diff(words.first)
    n_bytes = np.diff(offsets)
    per_word, per_byte = 1.0 / np.maximum(n_words, 1), 1.0 / np.maximum(n_bytes, 1)
    bucket = (words.hash % np.uint64(WORD_BUCKETS)).astype(np.int64)
    bag = np.bincount(words.text * WORD_BUCKETS + bucket, minlength=n * WORD_BUCKETS).reshape(n, WORD_BUCKETS)
    bag = np.sqrt(bag * per_word[:, None])
    kinds = [_counts(data == c, offsets) * per_word for c in SYMBOLS]
    kinds += [_counts((data >= 48) & (data <= 57), offsets) * per_byte, _counts((data >= 65) & (data <= 90), offsets) * per_byte]

    def distinct_share(hashes, owner):
        total = np.bincount(owner, minlength=n)
        order = np.lexsort((hashes, owner))
        h, o = hashes[order], owner[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])[: len(h)]
        return np.bincount(o[new], minlength=n) / np.maximum(total, 1)

    repetition = [distinct_share(words.hash, words.text), distinct_share(*words.shingles(3))]
    letters = np.bincount(words.text, weights=words.end - words.start, minlength=n) * per_word
    content = np.column_stack([bag, np.minimum(np.array(kinds).T * 3, 3), *[r * 2 - 1 for r in repetition], np.minimum(letters / 5 - 1, 3)])

    lines = _counts(data == 10, offsets) + 1

    def hashed(column: pa.Array, size: int) -> np.ndarray:
        # A null is a value of its own; hashing goes by distinct values.
        codes = pc.dictionary_encode(pc.fill_null(column.cast(pa.string()), "\x00"))
        values = codes.dictionary.to_pylist()
        place = Words(pa.array([v.replace(" ", "_") or "\x01" for v in values], pa.string())).hash if values else np.zeros(0, np.uint64)
        out = np.zeros((n, size))
        if n:
            out[np.arange(n), (place % np.uint64(size)).astype(np.int64)[codes.indices.to_numpy()]] = 1
        return out

    metadata = np.column_stack(
        [
            hashed(hosts, HOST_BUCKETS),
            hashed(languages, LANGUAGE_BUCKETS),
            np.log1p(n_bytes) / 4 - 2,
            np.log1p(lines) - 2,
            np.log1p(n_bytes / lines) - 4,
            np.log1p(n_words / lines) - 2,
            np.minimum(n_bytes * per_word / 6 - 1, 3),
        ]
    )
    return content.astype(np.float16), metadata.astype(np.float16)


def fit(x: np.ndarray, y: np.ndarray, rule: Training) -> np.ndarray:
    """Weights (the last is the intercept) of a logistic model with balanced classes, by accelerated gradient steps."""
    x = np.column_stack([x, np.ones(len(x), x.dtype)]).astype(np.float64)
    balance = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    step = 1.0 / (0.25 * np.linalg.eigvalsh((x * balance[:, None]).T @ x)[-1] + rule.penalty)
    w = ahead = np.zeros(x.shape[1])
    for k in range(rule.steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead - step * (x.T @ (balance * (p - y)) + rule.penalty * ahead)
        ahead, w = new + k / (k + 3) * (new - w), new
    return w


def raw_score(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x.astype(np.float64) @ w[:-1] + w[-1]


def cells(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(raw_score(x, w), -REACH, REACH) * CELLS).astype(np.int32)


@dataclass
class Model:
    views: list  # weights of the content and the metadata view
    calibration: list  # (slope, intercept) of either
    combined: np.ndarray  # slopes of the calibrated scores, intercept

    def scores(self, content: np.ndarray, metadata: np.ndarray):
        """Probability of being good by content, by metadata, and by both."""
        z = [a * raw_score(x, w) + b for x, w, (a, b) in zip((content, metadata), self.views, self.calibration)]
        both = z[0] * self.combined[0] + z[1] * self.combined[1] + self.combined[2]
        return [1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (*z, both)]


def sure_limits(cell: np.ndarray, n: np.ndarray, share: float, good_share: float) -> tuple[int, int]:
    """(highest sure bad cell, lowest sure good cell): the outermost cells that hold the asked share on either side."""
    order = np.argsort(cell)
    cell, n = cell[order], n[order]
    asked = share * n.sum()
    low = cell[np.searchsorted(np.cumsum(n), max(asked * (1 - good_share), 1))]
    high = cell[::-1][np.searchsorted(np.cumsum(n[::-1]), max(asked * good_share, 1))]
    return int(low), int(high)


def co_train(labelled, y: np.ndarray, sure, rule: Training = Training()) -> Model:
    """``labelled``: features by content and by metadata. ``sure(views, turn, good_share)`` gives, for either view, the features
    of the unlabelled rows that it passes on (both pairs) and their labels."""
    if len(set(y.tolist())) < 2:
        certain = 0.0 if not len(y) else (10.0 if y[0] else -10.0)
        zero = [np.zeros(x.shape[1] + 1) for x in labelled]
        return Model(zero, [(1.0, 0.0)] * 2, np.array([0.0, 0.0, certain]))
    held = np.zeros(len(y), bool)
    for c in (0, 1):  # a quarter of either class calibrates
        held[np.flatnonzero(y == c)[3::4]] = True
    if len(set(y[held].tolist())) < 2:
        held[:] = False
    train_x = [[x[~held]] for x in labelled]
    train_y = [[y[~held]], [y[~held]]]
    views = [fit(np.concatenate(x), np.concatenate(t), rule) for x, t in zip(train_x, train_y)]
    for turn in range(rule.rounds):
        passed = sure(views, turn, float(y.mean()))
        if not any(len(told) for _, told in passed):
            break
        for view, (rows, told) in enumerate(passed):
            train_x[1 - view].append(rows[1 - view])
            train_y[1 - view].append(told)
        views = [fit(np.concatenate(x), np.concatenate(t), rule) for x, t in zip(train_x, train_y)]
    check = held if held.any() else ~held
    truth = y[check].astype(float)
    scores = [raw_score(x[check], w)[:, None] for x, w in zip(labelled, views)]
    plain = Training(steps=400, penalty=1e-3)
    calibration = [tuple(fit(s, truth, plain)) for s in scores]
    both = np.column_stack([a * s + b for s, (a, b) in zip(scores, calibration)])
    return Model(views, calibration, fit(both, truth, plain))


def _packed(x: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in x], pa.binary())


def _unpacked(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float16).reshape(len(rows), -1) if rows else np.zeros((0, 1), np.float16)


def _feature_rows(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            views = features(part.column("text"), part.column("host"), part.column("language"))
            told = pc.is_valid(part.column("text"))
            columns = [part.column("row"), part.column("doc_id"), told, *[_packed(x) for x in views]]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "told", "content", "metadata"])


def featurise(docs: DataFrame) -> DataFrame:
    """(row, doc_id, told, content, metadata): ``row`` holds the columns that are kept, ``told`` says whether there is a text."""
    kept = [c for c in docs.columns if c.lower() not in ("text", "host", "language", *RESULTS)]
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "doc_id", *[F.col(c).cast("string") for c in ("text", "host", "language")])
    schema = source.select("row", "doc_id").schema.add("told", "boolean").add("content", "binary").add("metadata", "binary")
    return source.mapInArrow(_feature_rows, schema)


def _graded(shared):
    def grade(batches):
        for batch in batches:
            if batch.num_rows:
                both = [pa.array(cells(_unpacked(batch.column(c)), w)) for c, w in zip(("content", "metadata"), shared.value)]
                yield pa.RecordBatch.from_arrays([batch.column("vector"), *both], names=["vector", "c0", "c1"])

    return grade


def _sure_rows(fresh: DataFrame, rule: Training):
    """``sure`` of :func:`co_train` over ``fresh``: (vector, content, metadata) of all unlabelled rows."""
    spark = fresh.sparkSession
    gone: set[int] = set()  # passed on in earlier rounds: at most rounds x 2 x exchanged

    def sure(views, turn, good_share):
        shared = spark.sparkContext.broadcast(views)
        graded = fresh.mapInArrow(_graded(shared), "vector bigint, c0 int, c1 int").groupBy("vector").agg(F.first("c0").alias("c0"), F.first("c1").alias("c1"))
        graded = freeze(graded, "graded").filter(~F.col("vector").isin(list(gone)))
        limits = []
        for c in ("c0", "c1"):  # at most 2 x REACH x CELLS + 1 rows
            counts = graded.groupBy(c).agg(F.count(F.lit(1)).alias("n")).toArrow()
            if not counts.num_rows:
                return [((np.zeros((0, len(views[0]) - 1)), np.zeros((0, len(views[1]) - 1))), np.zeros(0))] * 2
            limits.append(sure_limits(counts.column(c).to_numpy(), counts.column("n").to_numpy(), rule.share, good_share))
        verdict = [F.when(F.col(c) >= high, 1).when(F.col(c) <= low, 0) for c, (low, high) in zip(("c0", "c1"), limits)]
        judged = graded.select("vector", verdict[0].alias("v0"), verdict[1].alias("v1")).filter("v0 IS NULL OR v1 IS NULL OR v0 = v1")
        many = {1: max(1, round(rule.exchanged * good_share))}
        many[0] = max(1, rule.exchanged - many[1])
        picked = []
        for view in ("v0", "v1"):
            for value in (1, 0):
                some = judged.filter(F.col(view) == value).orderBy(F.xxhash64("vector", F.lit(turn)), "vector").limit(many[value])
                picked += [(int(r.vector), view, value) for r in some.select("vector").collect()]
        gone.update(v for v, _, _ in picked)
        names = spark.createDataFrame(sorted({(v,) for v, _, _ in picked}), "vector bigint")
        found = fresh.join(F.broadcast(names), "vector").groupBy("vector").agg(F.first("content").alias("content"), F.first("metadata").alias("metadata")).toArrow()
        place = {v: k for k, v in enumerate(found.column("vector").to_pylist())}
        both = [_unpacked(found.column(c)) for c in ("content", "metadata")]
        passed = []
        for view in ("v0", "v1"):
            rows = [place[v] for v, of, _ in picked if of == view]
            passed.append(([x[rows] for x in both], np.array([value for _, of, value in picked if of == view], float)))
        shared.unpersist()
        return passed

    return sure


def train_on(made: DataFrame, labels: DataFrame, rule: Training = Training()) -> Model:
    """``made``: written rows of :func:`featurise`. ``labels``: doc_id, quality (1 good, 0 bad)."""
    usable = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("y"))
    usable = freeze(usable, "usable_labels")
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rule.labelled)
    known = made.filter("told").join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
        F.first("y").alias("y"), F.min(F.struct("content", "metadata")).alias("x")
    )
    known = known.select("doc_id", "y", "x.content", "x.metadata").orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    labelled, y = [_unpacked(known.column(c)) for c in ("content", "metadata")], known.column("y").to_numpy().astype(float)
    fresh = made.filter("told").join(sized(usable.select("doc_id")), "doc_id", "left_anti")
    fresh = fresh.select(F.xxhash64("content", "metadata").alias("vector"), "content", "metadata")
    return co_train(labelled, y, _sure_rows(fresh, rule), rule)


def train(docs: DataFrame, labels: DataFrame, rule: Training = Training()) -> Model:
    """``docs``: doc_id, text, host, language. ``labels``: doc_id, quality (1 good, 0 bad)."""
    return train_on(freeze(featurise(docs), "features"), labels, rule)


def _scorer(shared):
    def score(batches):
        for batch in batches:
            if batch.num_rows:
                values = shared.value.scores(*[_unpacked(batch.column(c)) for c in ("content", "metadata")])
                columns = [batch.column("row"), *[pa.array(np.round(v.astype(float), 6)) for v in values]]
                yield pa.RecordBatch.from_arrays(columns, names=["row", *RESULTS[:3]])

    return score


def score_on(made: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    shared = made.sparkSession.sparkContext.broadcast(model)
    schema = made.select("row").schema
    for name in RESULTS[:3]:
        schema = schema.add(name, "double")
    scored = made.select("row", "content", "metadata").mapInArrow(_scorer(shared), schema)
    return scored.select("row.*", *RESULTS[:3], (F.col("score") >= least).alias("kept"))


def score(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``docs`` without text, host and language, with p_content, p_metadata, score and ``kept`` (score of ``least`` or more)."""
    return score_on(featurise(docs), model, least)


@query("op5_cotraining")
def op5_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("language"))
    made = freeze(featurise(docs), "features")
    return score_on(made, train_on(made, table(spark, sf_dir, "labels")))
