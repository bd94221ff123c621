"""Importance resampling towards a target distribution (operator 11).

Features of a text are its words and pairs of neighbouring words, hashed by CRC-32 into buckets. Texts of the corpus and
of the target are counted by bucket; the logarithm of the ratio of both smoothed shares is the bucket's gain, and a
document's weight the mean of the gains over its features. Weight plus Gumbel noise from the document's id is its score;
the highest scores are drawn, which samples without replacement in proportion to the exponential of the weight.

Scores are array-scored: words of a slice are found in one byte array, their checksums go on a byte at a time for all
words at once, and gains are summed by document. Ranks come from a least-significant-digit radix sort over the cluster:
the key is (highest score less the score, id less the least id) cut into digits; each pass counts digits by block,
turns counts into offsets, and so knows each row's destination from its digit, the rows of its digit in earlier blocks
and those before it in its own. A destination is the place for the next pass and, after the last one, the rank.
The driver sees the counts by bucket and the totals by digit, both of fixed length.

Defined results: null and empty texts have no features and weight 0; a null id takes part with the noise of an empty id
and comes last among ties; repeated rows are scored and ranked each, next to each other in any order; ties go to the
smaller id; very long texts are read whole; other columns are not looked at, whatever their names; an empty corpus gives
an empty result, an empty target leaves only the corpus' own shares in the gains.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from countertide.llm.common import slices, table
from countertide.llm.places import TASK_BITS, block_bits, places_in_class
from countertide.llm.registry import query
from countertide.llm.textarrays import LOWER, flat_bytes
from countertide.plans.shared import freeze

BUCKETS = 10_000
SEED = 7
MIN_WORDS = 20
DIGIT_BITS = 12
#: Longer words, in bytes, are summed one by one.
_STEPS = 48

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _crc_table() -> np.ndarray:
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, np.uint32(0xEDB88320) ^ (values >> np.uint32(1)), values >> np.uint32(1))
    return values.astype(np.uint32)


_CRC = _crc_table()


def _go_on(state: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return _CRC[(state ^ codes) & np.uint32(255)] ^ (state >> np.uint32(8))


def _checksums(data: np.ndarray, start: np.ndarray, size: np.ndarray, state: np.ndarray) -> np.ndarray:
    """The CRC states after the words, begun from ``state``."""
    order = np.argsort(-size, kind="stable")
    at, length, out = start[order], size[order], state[order]
    long = int(np.searchsorted(-length, -_STEPS, "left"))
    for step in range(min(_STEPS, int(length[0]) if len(length) else 0)):
        alive = int(np.searchsorted(-length, -step, "left"))
        out[long:alive] = _go_on(out[long:alive], data[at[long:alive] + step])
    for k in range(long):
        seed = int(out[k]) ^ 0xFFFFFFFF
        out[k] = zlib.crc32(data[at[k] : at[k] + length[k]].tobytes(), seed) ^ 0xFFFFFFFF
    back = np.empty_like(out)
    back[order] = out
    return back


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, CRC-32 of the feature) of each feature in no set order, and the number of words of each text."""
    data, offsets = flat_bytes(texts)
    data = LOWER[data]
    inside = _INSIDE[data]
    n = len(data)
    borders = np.unique(offsets[(offsets > 0) & (offsets < n)])
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[borders] |= inside[borders]
    ends[:-1] &= ~inside[1:]
    ends[borders - 1] |= inside[borders - 1]
    start = np.flatnonzero(begins)
    size = np.flatnonzero(ends) + 1 - start
    owner = np.searchsorted(offsets, start, "right") - 1
    full = np.uint32(0xFFFFFFFF)
    single = _checksums(data, start, size, np.full(len(start), full))
    pair = np.flatnonzero(owner[1:] == owner[:-1]) + 1
    double = _checksums(data, start[pair], size[pair], _go_on(single[pair - 1], np.uint32(0x20)))
    return np.concatenate([owner, owner[pair]]), np.concatenate([single, double]) ^ full, np.bincount(owner, minlength=len(texts))


def bucket_counts(docs: DataFrame, text: str, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "_text"):
                _, crc, _ = features(part.column("_text"))
                counts += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(counts[hit])], names=["bucket", "n"])

    source = docs.select(F.col(f"`{text}`").cast("string").alias("_text"))
    counted = source.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.collect():  # one row a bucket
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of the smoothed shares."""
    s, t, width = corpus.astype(float), target.astype(float), len(corpus)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + width) / ((s + 1) * (t.sum() + width)))).astype(np.int64)


def noise(key: str, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return int(np.floor(-1000 * np.log(-np.log((h + 0.5) / 4294967296))))


def scored(docs: DataFrame, gain: np.ndarray, id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """Per row: the id, n_words, n_features, weight, score, and ``_place``, where the row was met."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        values = shared.value
        place = TaskContext.get().partitionId() << TASK_BITS
        for batch in batches:
            for part in slices(batch, "_text"):
                owner, crc, words = features(part.column("_text"))
                rows = part.num_rows
                n_features = np.bincount(owner, minlength=rows)
                total = np.zeros(rows, np.int64)
                np.add.at(total, owner, values[crc % np.uint32(len(values))])
                weight = total // np.maximum(n_features, 1)
                keys = part.column("_id").to_pylist()
                score = weight + np.array([noise("" if k is None else str(k), seed) for k in keys], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), *(pa.array(c.astype(np.int64)) for c in (words, n_features, weight, score, place + np.arange(rows)))],
                    names=["_id", "n_words", "n_features", "weight", "score", "_place"],
                )
                place += rows

    source = docs.select(F.col(f"`{id}`").cast("bigint").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    out = source.mapInArrow(run, "_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint, _place bigint")
    return out.withColumnRenamed("_id", id)


def radix_ranks(rows: DataFrame, id: str, digit_bits: int = DIGIT_BITS) -> DataFrame:
    """``rows`` (id, score, _place, ...) with ``rank`` in the order of (score descending, id); stable passes over key digits."""
    spark = rows.sparkSession
    low, high, first, last, n = rows.agg(F.min("score"), F.max("score"), F.min(id), F.max(id), F.count(F.lit(1))).head()
    if not n:
        return rows.withColumn("rank", F.lit(None).cast("bigint"))
    first, last = (0, -1) if first is None else (first, last)
    id_bits, score_bits = (last - first + 1).bit_length(), (high - low).bit_length()
    if id_bits > 63:
        raise ValueError("ids span more than 63 bits")
    # The two parts of the key; rows without id get the number behind the last one.
    by_id, by_score = F.coalesce(F.col(id) - first, F.lit(last - first + 1)), F.lit(high) - F.col("score")
    bits = block_bits(n, int(spark.conf.get("spark.sql.shuffle.partitions")))
    done = rows
    for at in range(0, max(id_bits + score_bits, 1), digit_bits):
        if at >= id_bits:
            value = F.shiftright(by_score, at - id_bits)
        elif at + digit_bits <= id_bits:
            value = F.shiftright(by_id, at)
        else:
            value = F.shiftright(by_id, at).bitwiseOR(F.shiftleft(by_score, id_bits - at))
        digit = value.bitwiseAND((1 << digit_bits) - 1).cast("int")
        totals = done.groupBy(digit.alias("_digit")).agg(F.count(F.lit(1)).alias("_n"))  # one row a digit: at most 2 ** digit_bits
        below = Window.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
        bases = totals.select("_digit", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_base"))
        placed = places_in_class(done, digit, "_place", bits, "_own").withColumn("_digit", digit)
        moved = placed.join(F.broadcast(bases), "_digit").withColumn("_place", F.col("_base") + F.col("_own"))
        done = freeze(moved.select(*rows.columns), "radix")
    return done.withColumn("rank", F.col("_place") + 1)


def ranked(
    docs: DataFrame,
    target: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = 25,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_features, weight, score and rank (null if not drawn).

    Drawn are ``percent`` in a hundred of the rows with ``min_words`` words or more.
    """
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    rows = freeze(scored(docs, gain, id, text, seed), "scored")
    able = rows.filter(F.col("n_words") >= min_words)
    draw = able.count() * percent // 100
    order = radix_ranks(able, id).withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = rows.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    return order.unionByName(rest).drop("_place")


def resample(docs: DataFrame, target: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns. An id is kept with all its rows if one is drawn."""
    drawn = ranked(docs, target, id, **options).filter("rank IS NOT NULL").select(F.col(id).alias("_drawn")).distinct()
    return docs.join(drawn, docs[f"`{id}`"].eqNullSafe(drawn["_drawn"]), "left_semi")


#: CRC-32 is written as eight steps a byte over the list of bytes; SHA-256 and logarithms are DuckDB's own.
SQL = f"""
WITH steps AS (
  SELECT list(v ORDER BY b) AS crc FROM (
    SELECT b, list_reduce([b::BIGINT] || [k::BIGINT FOR k IN range(8)],
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS b))
), split AS (
  SELECT 'd' AS side, doc_id AS key, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark
), feature AS (
  SELECT side, key, unnest(w || [w[k] || ' ' || w[k + 1] FOR k IN range(1, len(w))]) AS f FROM split
), bytes AS (
  SELECT f, [('0x' || hex(encode(f))[2 * k + 1 : 2 * k + 2])::BIGINT FOR k IN range(octet_length(encode(f)))] AS codes
  FROM (SELECT DISTINCT f FROM feature)
), bucket AS (
  SELECT f, xor(list_reduce([4294967295::BIGINT] || codes, lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])),
    4294967295) % {BUCKETS} AS bucket
  FROM bytes, steps
), counts AS (
  SELECT b.bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
  FROM feature JOIN bucket b USING (f) GROUP BY b.bucket
), gain AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {BUCKETS})::DOUBLE
    / ((s + 1)::DOUBLE * (sum(t) OVER () + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM counts
), weight AS (
  SELECT key, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM feature JOIN bucket USING (f) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY key
), score AS (
  SELECT key AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{SEED}:' || key)[1:8])::BIGINT + 0.5::DOUBLE)
      / 4294967296)))::BIGINT AS score
  FROM split LEFT JOIN weight USING (key) WHERE side = 'd'
), place AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_words >= {MIN_WORDS}) OVER () * 25 // 100 AS draw
  FROM score
)
SELECT doc_id, n_words, n_features, weight, score,
  CASE WHEN n_words >= {MIN_WORDS} AND place <= draw THEN place END AS rank FROM place
"""


@query("op11_importance", SQL)
def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))
