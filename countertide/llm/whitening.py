"""Embedding whitening by QDWH spectral divide and conquer (operator 12).

Entries become whole numbers, floor(64 c) + 1,000,000. Each distinct vector counts once: vectors are packed into bytes, so
that copies meet in a map-side aggregation, and written. One pass over the distinct vectors gives their number and sums,
a second one the covariance of the centred vectors, a third the covariance of the whitened ones, which shows how far it
is from the identity. What reaches the driver is of the size of a vector or of a covariance.

The covariance is split on the driver: the polar factor of (covariance - shift) is the matrix sign, so half of it plus the
identity projects on the components above the shift; the ranges of both projectors are invariant, and each part is split
again until single components are left. Polar factors come from the dynamically weighted Halley iteration (QDWH). The
components are broadcast and all rows are whitened where they lie.

Defined results: rows are left out whose vector is null or empty, holds null, NaN or infinite entries, has an entry beyond
2 ** 46 (its whole number would not be exact), or has another length than most vectors (of equally frequent lengths the
longest counts). A vector of equal entries with others, repeated rows and null ids are whitened each; components of equal
variance may be any basis of their space; components without variance (below 1e-13 of the largest) have whitened null and
take no part in the error of the identity, which is null if no component is left; a deviation beyond 63 bits is null. An
empty table gives an empty result. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countertide.llm.common import table
from countertide.llm.registry import query
from countertide.plans.shared import freeze

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Entries from here on have no exact whole number.
LARGEST = 2.0**46
#: A component with a smaller share of the largest variance has none.
NO_VARIANCE = 1e-13
_EPS = np.finfo(float).eps
_WIDTHS = (np.dtype("<i1"), np.dtype("<i2"), np.dtype("<i4"), np.dtype("<i8"))
#: Rows that are centred and multiplied at a time.
_ROWS = 4096


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by the QDWH iteration."""
    d = len(a)
    eye = np.eye(d)
    x = a / np.linalg.norm(a)
    try:
        low = 0.9 / np.sqrt(d) / np.linalg.norm(np.linalg.inv(x), 1)
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(max(low, _EPS), 1.0)
    for _ in range(40):
        u = np.cbrt(4 * (1 - low * low) / low**4)
        root = np.sqrt(1 + u)
        wa = root + 0.5 * np.sqrt(8 - 4 * u + 8 * (2 - low * low) / (low * low * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:d] @ q[d:].T)
        else:
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(eye + wc * (x.T @ x), x.T).T
        new = (new + new.T) / 2
        low = min(low * (wa + wb * low * low) / (1 + wc * low * low), 1.0)
        moved, x = np.linalg.norm(new - x), new
        if moved < _EPS ** (1 / 3) and 1 - low < 10 * _EPS:
            break
    return x


def _halves(a: np.ndarray, shift: float, seed: int = 0) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the components above and below ``shift``; None if it lies on one of them or to their one side."""
    d = len(a)
    projector = (polar(a - shift * np.eye(d)) + np.eye(d)) / 2
    rank = round(float(np.trace(projector)))
    if not 0 < rank < d or np.linalg.norm(projector @ projector - projector) > 1e-8:
        return None
    start = np.random.default_rng(seed).standard_normal((d, rank))
    basis, _ = np.linalg.qr(projector @ start)
    basis, _ = np.linalg.qr(projector @ basis, mode="complete")  # once more: its columns leave the range no more
    return basis[:, :rank], basis[:, rank:]


def spectral_divide(a: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors of a symmetric matrix, as columns in no set order."""
    scale = np.linalg.norm(a)

    def split(block: np.ndarray) -> np.ndarray:
        d = len(block)
        middle = float(np.trace(block)) / d
        if d == 1 or np.linalg.norm(block - middle * np.eye(d)) <= 4 * d * _EPS * scale:
            return np.eye(d)
        spread = float(np.linalg.norm(block - middle * np.eye(d))) / np.sqrt(d)
        # The median of the diagonal halves well; the mean lies between the extremes; a shift that meets a component gives way.
        for shift in (float(np.median(np.diag(block))), middle, *(middle + k * 1e-3 * spread for k in (1, -1, 7, -7, 31, -31, 127, -127))):
            halves = _halves(block, shift)
            if halves is not None:
                break
        else:
            return np.eye(d)  # all within rounding of one value
        parts = []
        for basis in halves:
            inner = basis.T @ block @ basis
            parts.append(basis @ split((inner + inner.T) / 2))
        return np.hstack(parts)

    return split((a + a.T) / 2)


@dataclass
class Whitening:
    """What is fitted: number and sums of the distinct whole-number vectors, components as columns, their variances, the trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def alive(self) -> np.ndarray:
        return self.variances > NO_VARIANCE * max(float(self.variances.max(initial=0.0)), 0.0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / self.n if np.abs(x).max(initial=0) < 2**62 // max(self.n, 1) else x - self.sums / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """One column a component; NaN where it has no variance."""
        out = np.full((len(x), len(self.variances)), np.nan)
        alive = self.alive
        out[:, alive] = self.centred(x) @ self.components[:, alive] / np.sqrt(self.variances[alive])
        return out

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of squares of n x - S; None beyond 63 bits."""
        far = max(int(np.abs(x).max(initial=0)) * self.n, int(np.abs(self.sums).max(initial=0))) * 2
        if far < 2**62:
            y = self.n * x - self.sums
            if int(np.abs(y).max(initial=0)) ** 2 * x.shape[1] < 2**63:
                return (y * y).sum(axis=1).tolist()
            y = y.astype(object)
        else:
            y = x.astype(object) * self.n - self.sums.astype(object)
        exact = (y * y).sum(axis=1).tolist()
        return [v if v < 2**63 else None for v in exact]


def _vectors(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, values) of the vectors with ``width`` entries; null entries become NaN."""
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]) if len(column) else np.zeros(0, int)
    rows = np.flatnonzero(np.asarray(column.is_valid()) & (sizes == width))
    values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    return rows, values.astype(float).reshape(len(rows), width)


def _whole(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * values).astype(np.int64)


def _good(values: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore"):
        return (np.abs(values) < LARGEST).all(axis=1)


def _pack(x: np.ndarray) -> list[bytes]:
    """Vectors as bytes, each as narrow as its largest entry allows; equal vectors give equal bytes."""
    reach = np.maximum(x.max(axis=1), -1 - x.min(axis=1)) if len(x) else np.zeros(0, np.int64)
    kind = (reach >= 1 << 7).astype(int) + (reach >= 1 << 15) + (reach >= 1 << 31)
    return [bytes([k]) + v.astype(_WIDTHS[k]).tobytes() for k, v in zip(kind, x)]


def _unpack(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(v, _WIDTHS[v[0]], offset=1) for v in column.to_pylist()], np.int64)


def _main_width(rows: DataFrame) -> int | None:
    """The most frequent length of a vector; of equals the longest."""
    sizes = rows.select(F.size("_v").alias("d")).filter("d > 0").groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    best = sizes.agg(F.max(F.struct("n", "d")).alias("m")).head()["m"]
    return best and best["d"]


def _rows(table_: DataFrame, id: str, vector: str) -> DataFrame:
    return table_.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{vector}`").cast("array<double>").alias("_v"))


def distinct_vectors(rows: DataFrame, width: int) -> DataFrame:
    """The distinct whole-number vectors, packed and without the shift, which no covariance sees. Written."""

    def run(batches):
        for b in batches:
            _, values = _vectors(b.column("_v"), width)
            yield pa.RecordBatch.from_arrays([pa.array(_pack(_whole(values[_good(values)])), pa.binary())], names=["x"])

    return freeze(rows.select("_v").mapInArrow(run, "x binary").distinct(), "vectors")


def _blocks(batches):
    for b in batches:
        for at in range(0, b.num_rows, _ROWS):
            yield _unpack(b.column("x").slice(at, _ROWS))


def _summed(vectors: DataFrame, width: int, product) -> np.ndarray:
    """Sum over blocks of vectors of the symmetric matrices ``product(block)``, added up by entry."""
    i, j = np.triu_indices(width)

    def run(batches):
        total = np.zeros((width, width))
        for x in _blocks(batches):
            total += product(x)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "v"])

    out = np.zeros((width, width))
    for a, b, v in vectors.mapInArrow(run, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v")).collect():  # width squared
        out[a, b] = out[b, a] = v
    return out


def fit(vectors: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """The leading components of written distinct vectors, by falling variance."""

    def run(batches):
        n, sums = 0, np.zeros(width, np.int64)
        for x in _blocks(batches):
            n += len(x)
            sums += x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, width)), pa.array(np.concatenate([[n], sums]))], names=["j", "s"])

    total = {j: s for j, s in vectors.mapInArrow(run, "j bigint, s bigint").groupBy("j").agg(F.sum("s")).collect()}  # width + 1
    n, sums = total.get(-1, 0), np.array([total.get(j, 0) for j in range(width)], np.int64)
    centre = Whitening(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)

    def spread(x):
        c = centre.centred(x)
        return c.T @ c

    covariance = _summed(vectors, width, spread) / max(n, 1)
    basis = spectral_divide(covariance)
    variances = np.einsum("ij,ik,kj->j", basis, covariance, basis)
    order = np.argsort(-variances, kind="stable")[:components]
    return Whitening(n, sums, basis[:, order], np.maximum(variances[order], 0.0), float(np.trace(covariance)))


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of (covariance of the whitened distinct vectors - identity)."""
    alive = model.alive
    k = int(alive.sum())
    if not k or not model.n:
        return None

    def sums(batches):
        total = np.zeros(k)
        for x in _blocks(batches):
            total += model.whiten(x)[:, alive].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(total)], names=["j", "s"])

    mean = np.zeros(k)
    for j, s in vectors.mapInArrow(sums, "j bigint, s double").groupBy("j").agg(F.sum("s")).collect():
        mean[j] = s / model.n

    def spread(x):
        c = model.whiten(x)[:, alive] - mean
        return c.T @ c

    return float(np.abs(_summed(vectors, k, spread) / model.n - np.eye(k)).max())


_COLUMNS = "n bigint, deviation bigint, component int, whitened double, explained double, identity_error double"


def whiten(table_: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per row that stays and component: the id, n, deviation, component (from 1), whitened, explained, identity_error."""
    spark = table_.sparkSession
    rows = _rows(table_, id, vector)
    width = _main_width(rows)
    names = ["_id", *[c.split()[0] for c in _COLUMNS.split(", ")]]
    schema = rows.select("_id").schema
    for f in spark.createDataFrame([], _COLUMNS).schema:
        schema = schema.add(f.name, f.dataType, True)
    if width is None:
        return spark.createDataFrame([], schema).withColumnRenamed("_id", id)
    vectors = distinct_vectors(rows, width)
    model = fit(vectors, width, components)
    error = identity_error(vectors, model)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        k = len(m.variances)
        explained = m.variances / m.trace if m.trace > 0 else np.full(k, np.nan)
        for b in batches:
            kept, values = _vectors(b.column("_v"), width)
            good = _good(values)
            kept, x = kept[good], _whole(values[good])
            times = len(x) * k
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("_id").take(pa.array(np.repeat(kept, k))),
                    pa.array(np.full(times, m.n)),
                    pa.array(m.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(m.whiten(x).ravel(), from_pandas=True),
                    pa.array(np.tile(explained, len(x)), from_pandas=True),
                    pa.array([error] * times, pa.float64()),
                ],
                names=names,
            )

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id)


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
