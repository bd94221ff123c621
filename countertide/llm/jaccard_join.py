"""Similarity join of shingle sets by Jaccard, heavy and light sets apart (operator 10).

Equal sets form classes, so copies cost one row each. What remains is an overlap join between different sets:

* all sets order their shingles alike, those met often last, then by hash. Two sets of a pair above the threshold share
  at least ``l`` of their first ``n - ceil(t n) + l`` shingles;
* *light* (small) sets list all pairs of shingles in that prefix (``l = 2``): fixed-size subsets, each a key;
* *heavy* (large) sets list single shingles (``l = 1``): inverted lists, which are scanned. Light sets so large that a
  heavy one can match them stand in these lists too;
* the boundary is where listing the subsets of a set costs as many rows as scanning its lists, by the mean length of a
  list, measured over the corpus.

Keys that only one set holds are dropped by an aggregation that is combined before its shuffle. Each list is scanned from
a few central pivots first: its members are verified against these, and links form components. Only pairs of different
components are verified after that, so a list of thousands of near copies gives thousands of pairs, not millions.

Near copies with too many edits to link stay apart, and all of them share most lists. So each set is told as its
difference from an *anchor*, the most central set of its neighbourhood: two sets differ by the symmetric difference of
these differences, hence sets of one anchor link only if their differences overlap enough. That is an overlap join
again, on differences, where edits of one's own come first and are in no other list.

Whole sets are larger than the texts, so they travel for likely pairs alone. Each set has a string of two to four bits a
shingle, each bit the parity of the number of shingles that fall on it. Where two strings differ the sets differ too, so
pairs whose strings differ more than a link allows are dropped without loss. Verification of the others is exact, on
whole sets.

Defined results: null or empty texts have no shingles and no links, and are a component each; rows of one doc_id count as
one document, which joins what any of them links to; an empty table gives an empty result; rows without id are documents of
their own, whose component is the least id that they are linked with, else null. Where ids are missing or repeated, rows
are numbered in a written table and joined by these numbers. Very long texts are cut into shingles whole, one at a time.
Ties between equal sets are settled by the least id. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from countertide.llm.common import BROADCAST_ROWS, sized, slices, table
from countertide.llm.components import components
from countertide.llm.registry import query
from countertide.llm.textarrays import Words, mixed
from countertide.plans.shared import freeze

#: A shingle is *frequent* from this share of all occurrences on: at most 2 ** 22 shingles can be, whatever the corpus.
FREQUENT = 2.0**-22
COUNTED = 4 << 20  # occurrences that are counted together
HELD_BYTES = 1 << 20  # of text that a worker cuts into shingles at a time
#: Pairs a member up to which no further turn of pivots is made: a turn shuffles each member several times.
COMPARED = 16
DIRECT = 4  # pairs a member of a list up to which its members are compared as they are, without anchors
PLANNED = 64  # one shingle in so many tells the length of lists, for the boundary alone


@dataclass(frozen=True)
class Similarity:
    """Sets of ``words``-word shingles that link from ``percent`` of their union on."""

    words: int = 5
    percent: int = 80

    def needed(self, n):
        """Least overlap of a set of ``n`` with any set it can link to."""
        return -((-n * self.percent) // 100)


_EXTRACT = pa.schema([("kind", pa.int8()), ("doc_id", pa.int64()), ("key", pa.binary()), ("n", pa.int64()), ("bits", pa.binary())])


def text_sets(texts: pa.Array, rule: Similarity):
    """Sorted distinct shingle hashes of each text."""
    hashes, owner = Words(texts).shingles(rule.words)
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]


def parities(s: np.ndarray) -> bytes:
    """At least two bits a shingle: bit ``i`` is the parity of the number of shingles that fall on ``i``."""
    width = max(64, 1 << (2 * len(s) - 1).bit_length())
    falls = (mixed(s) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits((np.bincount(falls, minlength=width) & 1).astype(np.uint8)).tobytes()


def differing(x: np.ndarray, y: np.ndarray) -> int:
    """Bits in which two parity strings differ, the longer one folded: never more than the sets have different shingles."""
    width = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(z.reshape(-1, width), axis=0) for z in (x, y))
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


def _extractor(rule: Similarity):
    """Kind 0: a document's set as a digest, a size and its parities. Kind 1: shingles that are frequent in a part of the corpus, with
    their count. Kind 2: a sample of prefix shingles (by hash), for planning."""

    def rows(kind, ids, keys, ns, bits=None):
        columns = [pa.array(np.full(len(ns), kind), pa.int8()), pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(ns, pa.int64())]
        bits = pa.nulls(len(ns), pa.binary()) if bits is None else pa.array(bits, pa.binary())
        return pa.RecordBatch.from_arrays([*columns, bits], schema=_EXTRACT)

    def frequent(held):
        values = np.concatenate(held)
        held.clear()
        values.sort()
        apart = max(2, int(np.ceil(FREQUENT * len(values)))) - 1
        often = np.unique(values[apart:][values[apart:] == values[: max(0, len(values) - apart)]])
        counts = np.searchsorted(values, often, "right") - np.searchsorted(values, often)
        return rows(1, often.view(np.int64), pa.nulls(len(often), pa.binary()), counts)

    def extract(batches):
        held, n_held = [], 0
        for batch in batches:
            for part in slices(batch, "_text", HELD_BYTES):
                sets = text_sets(part.column("_text"), rule)
                sizes = np.array([len(s) for s in sets], np.int64)
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield rows(0, part.column("_id"), keys, sizes, [parities(s) for s in sets])
                sampled = np.concatenate([s[: len(s) - rule.needed(len(s)) + 1] for s in sets]) if len(sets) else np.zeros(0, np.uint64)
                sampled = sampled[mixed(sampled) % np.uint64(PLANNED) == 0]
                yield rows(2, sampled.view(np.int64), pa.nulls(len(sampled), pa.binary()), np.ones(len(sampled), np.int64))
                held += sets
                n_held += int(sizes.sum())
                if n_held >= COUNTED:
                    yield frequent(held)
                    n_held = 0
        if n_held:
            yield frequent(held)

    return extract


def _boundary(planned: DataFrame, frequent: DataFrame, rule: Similarity) -> int:
    """Largest size of a light set: listing C(p + 1, 2) subsets costs no more than scanning p lists of the mean length."""
    lists = planned.join(frequent.select("doc_id"), "doc_id", "left_anti").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c"))
    row = lists.agg(F.sum(F.col("c") * F.col("c")).alias("cc"), F.sum("c").alias("c")).first()
    mean = row["cc"] / row["c"] if row["c"] else 1.0
    p = max(1, int(2 * mean) - 1)  # (p + 1) / 2 <= mean
    n = 1
    while n + 1 - rule.needed(n + 1) + 1 <= p:
        n += 1
    return n


def _ordered_prefix(s: np.ndarray, length: int, often: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first ``length`` shingles: those not frequent by hash, then frequent ones by count and hash."""
    if len(often):
        at = np.minimum(np.searchsorted(often, s), len(often) - 1)
        is_often = often[at] == s
        rare = s[~is_often]
        if len(rare) < length:
            late, n = s[is_often], counts[at[is_often]]
            return np.concatenate([rare, late[np.lexsort((late, n))]])[:length]
        return rare[:length]
    return s[:length]


def _lister(shared, rule: Similarity, boundary: int):
    """Keys of each set, with its document, its size and a hash of the whole set."""

    def keys_of(s, often, counts):
        n = len(s)
        if n < 2:  # another set with this shingle is less than half the same
            return s[:0]
        p = n - rule.needed(n) + 1
        out = []
        if n <= boundary:
            q = np.sort(_ordered_prefix(s, p + 1, often, counts))
            a, b = np.triu_indices(len(q), 1)
            out.append(mixed(mixed(q[a]) + np.uint64(2) * q[b]))
        if n > boundary or n >= rule.needed(boundary + 1):
            out.append(_ordered_prefix(s, p, often, counts))
        return np.concatenate(out)

    def lists(batches):
        often, counts = shared.value
        for batch in batches:
            for part in slices(batch, "_text", HELD_BYTES):
                sets = text_sets(part.column("_text"), rule)
                if not sets:
                    continue
                keys = [keys_of(s, often, counts) for s in sets]
                many = np.array([len(k) for k in keys])
                rows = pa.array(np.repeat(np.arange(len(sets)), many))
                whole = pa.array([int(mixed(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for s in sets], pa.int64())
                sizes = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), part.column("_id").take(rows), sizes.take(rows), whole.take(rows)],
                    names=["token", "doc_id", "n", "whole"],
                )

    return lists


def _set_writer(rule: Similarity):
    def sets(batches):
        for batch in batches:
            for part in slices(batch, "_text", HELD_BYTES):
                blobs = [s.tobytes() for s in text_sets(part.column("_text"), rule)]
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(blobs, pa.binary())], names=["doc_id", "shingles"])

    return sets


def _verifier(rule: Similarity):
    def verify(batches):
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            linked = []
            for k, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                if 100 * both >= rule.percent * (len(x) + len(y) - both):
                    linked.append(k)
            if linked:
                rows = pa.array(linked)
                yield pa.RecordBatch.from_arrays([a.take(rows), b.take(rows)], names=["a", "b"])

    return verify


def _with_sets(pairs: DataFrame, source: DataFrame, rule: Similarity, *carried: str) -> DataFrame:
    """Pairs (a, b), a written table, with both sets. Sets are made for the documents of these pairs alone and travel with them."""
    few = pairs.count() <= BROADCAST_ROWS
    ids = pairs.select(F.col("a").alias("_id")).unionAll(pairs.select("b"))
    texts = source.join(F.broadcast(ids) if few else ids, "_id", "left_semi").select("_id", "_text")
    sets = freeze(texts.mapInArrow(_set_writer(rule), "doc_id bigint, shingles binary"), "pair_sets")
    one = (F.broadcast(pairs) if few else pairs).join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
    two = one.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
    return two.select("a", "b", *carried, "set_a", "set_b")


def _sieve(batches):
    """Rows whose parity strings differ in ``most`` bits at most."""
    for batch in batches:
        kept = []
        for x, y, most in zip(batch.column("bits_a"), batch.column("bits_b"), batch.column("most").to_pylist()):
            x, y = np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)
            kept.append(differing(x, y) <= most)
        names = [c for c in batch.schema.names if c not in ("bits_a", "bits_b", "most")]
        yield batch.select(names).filter(pa.array(kept, pa.bool_()))


def _sieved(pairs: DataFrame, bits: DataFrame, most) -> DataFrame:
    """Pairs (a, b) whose sets may differ in no more than ``most`` shingles, a column of the sizes n_a and n_b.

    ``pairs`` is a written table. Strings are wider than pairs, so where pairs are few these go to the strings.
    """

    def told(x):
        return bits.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))

    narrow = sized(pairs)
    both = narrow.join(told("a"), "a").join(told("b").join(narrow.select("b"), "b", "left_semi"), "b")
    rows = both.select(*pairs.columns, most.cast("long").alias("most"), "bits_a", "bits_b")
    return rows.mapInArrow(_sieve, pairs.schema)


def _verified(pairs: DataFrame, bits: DataFrame, source: DataFrame, rule: Similarity) -> DataFrame:
    """The pairs (a, b) that link."""
    most = F.floor((F.col("n_a") + F.col("n_b")) * (100 - rule.percent) / (100 + rule.percent))
    pairs = freeze(_sieved(pairs, bits, most), "likely_pairs")
    return _with_sets(pairs, source, rule).mapInArrow(_verifier(rule), "a bigint, b bigint")


def _most(n, degree, boundary: int):
    """Most keys that a set can share with another one: a heavy set those of its prefix in open lists. Light sets are not bounded."""
    return F.when(n <= boundary, n).otherwise(degree)


def _compatible(n, most, m, most_m, percent: int):
    """Whether sizes, and the keys that both can share at most, allow a link."""
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (F.least(most, most_m) >= _asked(n, m, percent))


def _asked(n, m, percent: int):
    """Least number of single keys that two linked sets have in common.

    One of the prefixes ends first in the common order, and what it shares lies in both prefixes; so the overlap is at
    most the keys in common plus what follows that prefix, which may be either one.
    """
    overlap = F.ceil((n + m) * percent / (100 + percent))
    after = F.greatest(F.ceil(n * percent / 100), F.ceil(m * percent / 100)) - 1
    return overlap - after


def _enough(shared, n, m, rule: Similarity, boundary: int):
    """Whether two sets with ``shared`` keys in common can link. Lists of subsets say no more than that there is one."""
    return (F.least(n, m) <= boundary) | (shared >= _asked(n, m, rule.percent))


def join_classes(docs: DataFrame, rule: Similarity = Similarity(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each row of ``docs``."""
    source = docs.select(F.col(f"`{key}`").cast("long").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    per_id = source.groupBy("_id").agg(F.count(F.lit(1)).alias("c"))
    if not per_id.filter("c > 1 OR _id IS NULL").head(1):
        return _joined(source, rule)
    numbered = freeze(source.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    rows = _joined(numbered.select(F.col("_row").alias("_id"), "_text"), rule)
    rows = rows.withColumnRenamed("doc_id", "_row").join(numbered.select("_row", F.col("_id").alias("doc_id")), "_row")
    return _by_id(freeze(rows.select("doc_id", "n_shingles", "component_id"), "joined_rows"))


def _by_id(rows: DataFrame) -> DataFrame:
    """Components of numbered rows as those of ids: rows of one id belong together, the least id names a component."""
    ids = rows.filter("doc_id IS NOT NULL")
    least = ids.groupBy("doc_id").agg(F.min("component_id").alias("b"))
    ties = ids.join(least, "doc_id").select(F.col("component_id").alias("a"), "b").filter("a != b").distinct()
    labels = components(ties).select(F.col("node").alias("component_id"), F.col("component").alias("_to"))
    told = rows.join(labels, "component_id", "left").select("doc_id", "n_shingles", F.coalesce("_to", "component_id").alias("_component"))
    names = told.groupBy("_component").agg(F.min("doc_id").alias("component_id"))
    return told.join(names, "_component").select("doc_id", "n_shingles", "component_id")


def _joined(source: DataFrame, rule: Similarity) -> DataFrame:
    """The join of rows (_id, _text) whose ids are there and differ."""
    spark = source.sparkSession
    read = freeze(source.mapInArrow(_extractor(rule), "kind tinyint, doc_id bigint, key binary, n bigint, bits binary"), "sets")
    sized_docs = read.filter("kind = 0").select("doc_id", "key", "n")
    bits = read.filter("kind = 0 AND n > 1").select("doc_id", "n", "bits")
    classes = freeze(sized_docs.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")

    # A shingle with that share of all has it in one of the parts that were counted, so none is overlooked.
    total = sized_docs.agg(F.sum("n")).first()[0] or 0
    frequent = read.filter("kind = 1").groupBy("doc_id").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(2, int(FREQUENT * total)))
    frequent = freeze(frequent, "frequent")
    held = frequent.orderBy("doc_id").toArrow()
    often = held.column("doc_id").to_numpy().view(np.uint64)
    order = np.argsort(often)
    shared = spark.sparkContext.broadcast((often[order], held.column("n").to_numpy()[order]))
    boundary = _boundary(read.filter("kind = 2").select("doc_id"), frequent, rule)

    lists = freeze(source.mapInArrow(_lister(shared, rule, boundary), "token bigint, doc_id bigint, n bigint, whole bigint"), "lists")
    several_sets = freeze(
        lists.groupBy("token").agg(F.min("whole").alias("w0"), F.max("whole").alias("w1")).filter("w0 != w1").select("token"),
        "shared_keys",
    )
    # Copies stand in the lists of their class's first document already.
    copies = freeze(sized_docs.filter("n > 0").join(classes.filter("copies > 1").select("key", "rep"), "key").filter("doc_id != rep").select("doc_id").distinct(), "copies")
    members = lists.select("token", "doc_id", "n").join(several_sets, "token").join(sized(copies), "doc_id", "left_anti")
    members = freeze(members, "members")
    members = members.withColumn("component", F.col("doc_id"))

    n_documents = members.agg(F.approx_count_distinct("doc_id")).first()[0]
    labels, tried, pairs_left, turn = None, None, float("inf"), 0
    while n_documents:
        last = False
        if turn:  # at first every document is a component, so every key of several sets is an open list
            before = pairs_left
            per_list = members.groupBy("token", "component").agg(F.count(F.lit(1)).alias("c"))
            per_list = per_list.groupBy("token").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("mm"))
            long = (F.col("m") * F.col("m") - F.col("mm") > 2 * DIRECT * F.col("m")).alias("long")
            open_lists = freeze(per_list.filter("m * m > mm").select("token", "m", "mm", long), "open_lists")
            pairs_left, members_left, any_long = open_lists.agg(F.sum((F.col("m") * F.col("m") - F.col("mm")) / 2), F.sum("m"), F.max("long")).first()
            if pairs_left is None:
                break
            # Where pivots linked few of the documents, others would link as few.
            few = labels is None or 2 * labels.count() < n_documents
            last = pairs_left <= COMPARED * members_left or pairs_left > 0.7 * before or few
            members = members.join(open_lists.select("token", "long"), "token")
        # Documents of different components share no closed list, so what they can share shrinks with the open ones.
        degrees = members.groupBy("doc_id").agg(F.count(F.lit(1)).alias("degree"))
        members = members.join(degrees, "doc_id").withColumn("most", _most(F.col("n"), F.col("degree"), boundary))
        members = freeze(members, "open_members")
        if not last:
            pairs = _pivot_pairs(members, rule, boundary, turn)
        else:
            apart = members.filter("NOT long").withColumn("anchor", F.lit(None).cast("long"))
            pairs = None
            if any_long:
                crowded = members.filter("long")
                deltas = _deltas(crowded, bits, source, rule)
                apart = apart.unionByName(crowded.join(sized(deltas.select("doc_id", "anchor")), "doc_id", "left"))
                pairs = _delta_pairs(deltas, rule)
            crossed = _cross_pairs(apart, rule, boundary)
            pairs = crossed if pairs is None else crossed.unionAll(pairs).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = freeze(pairs, "pairs")
        new = freeze(_verified(pairs, bits, source, rule), "links")
        if not new.isEmpty():
            labels = components(new if labels is None else new.unionAll(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))))
        if last:
            break
        tried = pairs if tried is None else tried.unionAll(pairs)
        if labels is not None:
            to = labels.select(F.col("node").alias("doc_id"), F.col("component").alias("_to"))
            members = members.join(sized(to), "doc_id", "left").withColumn("component", F.coalesce("_to", "doc_id"))
        members = freeze(members.select("token", "doc_id", "n", "component"), "members")
        turn += 1
    if labels is None:
        labels = spark.createDataFrame([], "node bigint, component bigint")
    return _assembled(sized_docs, classes, labels)


def _cross_pairs(members: DataFrame, rule: Similarity, boundary: int) -> DataFrame:
    """All pairs that share enough keys, whose components and anchors differ and whose sizes allow a link."""

    def side(x):
        return members.select("token", F.col("doc_id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "most", "component", "anchor")])

    near = (F.col("a") > F.col("b")) & (F.col("component_a") != F.col("component_b"))
    near &= F.coalesce(F.col("anchor_a") != F.col("anchor_b"), F.lit(True))
    near &= _compatible(F.col("n_a"), F.col("most_a"), F.col("n_b"), F.col("most_b"), rule.percent)
    a, b = side("a"), side("b")
    counted = a.join(b, (a["token"] == b["token"]) & near).groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("c"))
    return counted.filter(_enough(F.col("c"), F.col("n_a"), F.col("n_b"), rule, boundary)).select("a", "b")


def _pivot_pairs(members: DataFrame, rule: Similarity, boundary: int, turn: int) -> DataFrame:
    """Each member of a list with a few pivots of other components.

    A list's pivots are its most central members, one of each of three classes by hash: those with most keys that other
    sets have too, hence with fewest shingles of their own. A member takes the most central pivot of each class.
    """
    central = F.struct("degree", (-F.col("doc_id")).alias("minus"), "n", "most", "component")
    of = F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.lit(3))
    pivots = members.groupBy("token").agg(*[F.max(F.when(of == j, central)).alias(f"p{j}") for j in range(3)])
    met = members.join(pivots, "token").select(
        "doc_id", "n", "most", "component", F.posexplode(F.array("p0", "p1", "p2")).alias("j", "p")
    )
    met = met.filter("component != p.component").filter(_compatible(F.col("n"), F.col("most"), F.col("p.n"), F.col("p.most"), rule.percent))
    counted = met.groupBy("doc_id", "n", "j", "p").agg(F.count(F.lit(1)).alias("c"))
    counted = counted.filter(_enough(F.col("c"), F.col("n"), F.col("p.n"), rule, boundary))
    one = counted.groupBy("doc_id", "j").agg((-F.max_by("p.minus", F.struct("p.degree", "c", "p.minus"))).alias("other"))
    return one.select(F.greatest("doc_id", "other").alias("a"), F.least("doc_id", "other").alias("b")).distinct()


def _anchors(members: DataFrame) -> DataFrame:
    """(doc_id, n, component, anchor): each document's most central neighbour, followed from one to the next.

    Any anchor gives right results; following them makes documents of one neighbourhood agree on one.
    """
    best = members.groupBy("token").agg(F.max(F.struct("degree", (-F.col("doc_id")).alias("minus"))).alias("p"))
    told = members.join(best, "token").groupBy("doc_id").agg(
        F.min("n").alias("n"), F.min("component").alias("component"), F.max("p").alias("p")
    )
    told = freeze(told.select("doc_id", "n", "component", (-F.col("p.minus")).alias("anchor")), "anchors")
    for _ in range(3):  # each time twice as far
        further = sized(told).select(F.col("doc_id").alias("anchor"), F.col("anchor").alias("_to"))
        told = told.join(further, "anchor").select("doc_id", "n", "component", F.col("_to").alias("anchor"))
        told = freeze(told, "anchors")
    return told


def _subtract(batches):
    """Symmetric difference of a set and its anchor's; null where it is longer than half the set."""
    for batch in batches:
        deltas = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            delta = np.setxor1d(x, y, assume_unique=True)
            deltas.append(delta.view(np.int64) if 2 * len(delta) <= len(x) else None)
        kept = [batch.column(c) for c in ("a", "b", "n", "component")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(deltas, pa.list_(pa.int64()))], names=["doc_id", "anchor", "n", "component", "delta"])


def _deltas(members: DataFrame, bits: DataFrame, source: DataFrame, rule: Similarity) -> DataFrame:
    """(doc_id, anchor, n, component, delta) of documents that are near their anchor."""
    pairs = _anchors(members).select(F.col("doc_id").alias("a"), F.col("anchor").alias("b"), "n", "component")
    pairs = freeze(_sieved(pairs, bits, F.floor(F.col("n_a") / 2)), "near_anchors")
    both = _with_sets(pairs, source, rule, "n", "component")
    schema = "doc_id bigint, anchor bigint, n bigint, component bigint, delta array<bigint>"
    return freeze(both.mapInArrow(_subtract, schema).filter("delta IS NOT NULL"), "deltas")


def _delta_pairs(deltas: DataFrame, rule: Similarity) -> DataFrame:
    """Pairs of one anchor that can link, by their differences x and y from it.

    Sets of sizes n and m link if |x ^ y| (100 + percent) <= (n + m) (100 - percent). With
    ``e = |x| (100 + percent) - n (100 - percent)`` that is 2 |x & y| (100 + percent) >= e(x) + e(y). Where this sum is
    not above 0, both link to the set with the least ``e`` of the anchor: one pair each is enough. Otherwise the
    differences share an entry within their prefixes, by the least overlap that any partner asks for.
    """
    up, down = 100 + rule.percent, 100 - rule.percent
    told = deltas.withColumn("d", F.size("delta").cast("long")).withColumn("e", F.col("d") * up - F.col("n") * down)
    least = told.groupBy("anchor").agg(
        F.min(F.struct("e", "doc_id", "component")).alias("least"), F.min("component").alias("c0"), F.max("component").alias("c1")
    )
    least = freeze(least.filter("c0 != c1").select("anchor", "least"), "least")
    told = freeze(told.join(sized(least), "anchor"), "told")
    certain = told.filter("e + least.e <= 0 AND component != least.component").select("doc_id", F.col("least.doc_id").alias("other"))
    certain = certain.select(F.greatest("doc_id", "other").alias("a"), F.least("doc_id", "other").alias("b"))

    asked = F.greatest(F.lit(1), F.ceil((F.col("e") + F.col("least.e")) / (2 * up)))
    entries = told.select("anchor", "doc_id", "n", "component", "d", "e", (F.col("d") - asked + 1).alias("length"), F.explode("delta").alias("token"))
    entries = freeze(entries.filter("length > 0"), "entries")
    held = entries.groupBy("anchor", "token").agg(F.count(F.lit(1)).alias("c"), F.min("component").alias("c0"), F.max("component").alias("c1"))
    ranked = freeze(entries.join(held, ["anchor", "token"]), "ranked")
    # One document bounds the window: its difference.
    order = Window.partitionBy("anchor", "doc_id").orderBy("c", "token")
    listed = ranked.withColumn("place", F.row_number().over(order)).filter("place <= length AND c0 != c1")
    listed = freeze(listed.select("anchor", "token", "doc_id", "n", "component", "d", "e", (F.col("d") - F.col("place") + 1).alias("rest")), "delta_lists")

    def side(x):
        return listed.select("anchor", "token", F.col("doc_id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "component", "d", "e", "rest")])

    a, b = side("a"), side("b")
    near = (F.col("a") > F.col("b")) & (F.col("component_a") != F.col("component_b")) & (F.col("e_a") + F.col("e_b") > 0)
    near &= F.abs(F.col("d_a") - F.col("d_b")) * up <= (F.col("n_a") + F.col("n_b")) * down
    # All that two differences share lies at or after the first entry that they share.
    near &= F.least("rest_a", "rest_b") * (2 * up) >= F.col("e_a") + F.col("e_b")
    met = a.join(b, (a["anchor"] == b["anchor"]) & (a["token"] == b["token"]) & near)
    return met.select("a", "b").unionAll(certain).distinct()


def _assembled(sized_docs: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    told = classes.join(labels, classes["rep"] == labels["node"], "left").filter("copies > 1 OR component IS NOT NULL")
    told = freeze(told.select(F.col("key").alias("_key"), F.coalesce("component", "rep").alias("_component")), "class_labels")
    out = sized_docs.join(sized(told), F.col("key") == F.col("_key"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("_component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, rule: Similarity = Similarity(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents without those that link, directly or through others, to one with a smaller id; of repeated rows one."""
    joined = freeze(join_classes(docs, rule, text, key), "joined")
    gone = freeze(joined.filter("component_id < doc_id").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    kept = docs.join(sized(gone), F.col(f"`{key}`") == F.col("_gone"), "left_anti")
    counts = joined.agg(F.count("doc_id"), F.count_distinct("doc_id")).first()
    if counts[0] == counts[1]:
        return kept
    # Only rows that repeat an id are grouped; documents without id are not copies of each other.
    repeated = freeze(joined.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_many")), "repeated")
    many = kept.join(sized(repeated), F.col(f"`{key}`") == F.col("_many"), "left_semi").dropDuplicates([key])
    return kept.join(sized(repeated), F.col(f"`{key}`") == F.col("_many"), "left_anti").unionAll(many)


@query("op10_jaccard_join")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return join_classes(docs, Similarity(words=3, percent=90))
