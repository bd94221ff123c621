"""Benchmark passages in documents by SimHash of item-sized windows (operator 1).

Windows start at content-defined places: a word is a start if its hash is the least among the eight words from it on or
among the eight up to it. Item and document choose the same starts in a passage they share, so windows need not be tried
at every offset. Window lengths come from the items (a geometric row of sizes; each item takes the largest that leaves it
several windows). The SimHash of a window is the majority of its words' hashes in each of 64 bits; sums over windows are
differences of running sums, kept in wrapping bytes.

Fingerprints are cut into ``radius + 1`` blocks: two within ``radius`` bits agree in one block at least, so looking up
all blocks of all windows finds every pair within the radius. Candidates are then verified exactly: the document's words
around the window against the item's, by Jaccard similarity of word shingles weighted by their words' lengths, over the
best place of the item's own length.

Benchmark items are a query set: they are held in blocks of ``ITEM_BLOCK`` items, each block tried on all documents.

A large window covers the middle of its item, and a word changed there may change more bits than the radius. So each
item has second windows, small enough to fit between the changes that the similarity allows. Items of so few words that
what is in common may hold no start with a window behind it have windows at each of their words, which are tried at each
word of the documents. No place is lost if the item's words are of one length; else changes to many short words can leave
runs shorter than that.

Defined results: null or empty texts and items match nothing; items with fewer than ``shingle`` words are compared as
one whole sequence; repeated document rows give their matches each, repeated items give one match for each item_id; empty
tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countertide.llm.common import slices, table
from countertide.llm.registry import query
from countertide.llm.textarrays import Words, mixed

SIZES = (4, 6, 9, 13, 20, 30, 45, 67, 100)  # a sum of so many signs fits a byte
REACH = 8
ITEM_BLOCK = 20_000
HELD_BYTES = 512 << 10  # of text, whose words carry 64 signs each
HELD_WINDOWS = 1 << 15


@dataclass(frozen=True)
class Matching:
    radius: int = 3
    shingle: int = 5
    similarity: float = 0.8


def starts(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places of words whose hash is least among the ``REACH`` words that begin or end there, within their text.

    Of ``REACH`` words in a row one at least is the least of them, so every passage of so many words has a start in it.
    """
    n = len(hashes)
    picked = np.zeros(n, bool)
    if n < REACH:
        picked[:] = True
        return np.flatnonzero(picked)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, REACH)
    at = np.arange(len(windows)) + windows.argmin(axis=1)
    whole = text[: n - REACH + 1] == text[REACH - 1 :]
    picked[at[whole]] = True
    # Texts shorter than the reach start at each word.
    counts = np.bincount(text, minlength=int(text[-1]) + 1)
    picked |= (counts < REACH)[text]
    return np.flatnonzero(picked)


def running_signs(hashes: np.ndarray) -> np.ndarray:
    """Running sums, modulo 256, of +1 and -1 for the bits of each word; one row more than words."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    out = np.zeros((len(hashes) + 1, 64), np.int8)
    np.cumsum((bits << 1).view(np.int8) - np.int8(1), axis=0, dtype=np.int8, out=out[1:])
    return out


def fingerprints(sums: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    majority = (sums[start + size] - sums[start]) > 0
    return np.packbits(majority, axis=1).view("<u8").ravel()


def size_of(n_words: int) -> int:
    """Window size of an item: two thirds of what a start among its first ``REACH`` words leaves room for."""
    fitting = [s for s in SIZES if s <= max(SIZES[0], (n_words - REACH + 1) * 2 // 3)]
    return min(fitting[-1], n_words)


def clean_run(n_words: int, rule: Matching) -> int:
    """Words in a row that an item of ``n_words`` and any place similar to it have in common at least, for words of one length.

    The place keeps ``similarity`` of the item's shingles at least. Of ``n`` words cut into runs of at most ``r``, no more
    than ``(r - k + 1) (n + 1) / (r + 1)`` shingles of ``k`` words are whole.
    """
    k = rule.shingle
    if n_words < k:
        return n_words
    kept = rule.similarity * (n_words - k + 1) / (n_words + 1)
    return min(n_words, ceil((k - 1 + kept) / (1 - kept) - 1e-9))


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Index:
    """Fingerprints of a block of items, with one table for each block of bits."""

    def __init__(self, items: list[tuple[int, str]], rule: Matching):
        words = Words(pa.array([t for _, t in items], pa.string()))
        self.ids = [i for i, _ in items]
        self.rule = rule
        self.words = [words.hash[words.first[k] : words.first[k + 1]] for k in range(len(items))]
        self.lengths = [(words.end - words.start)[words.first[k] : words.first[k + 1]] for k in range(len(items))]
        self.by_size: dict[int, tuple] = {}
        #: Second windows, so small that one lies between the changed words of a place that is similar.
        self.smaller: dict[int, tuple] = {}
        #: Where what is in common need not hold a start and a window behind it, windows lie at each word, and so do the document's.
        self.short: dict[int, tuple] = {}
        found: dict[int, list] = {}
        smaller: dict[int, list] = {}
        short: dict[int, list] = {}
        for k, h in enumerate(self.words):
            if not len(h):
                continue
            sums, begin, room = running_signs(h), starts(h, np.zeros(len(h), np.int64)), clean_run(len(h), rule) - REACH + 1
            if room < SIZES[0]:
                windows = [(short, min(SIZES[0], len(h)), np.arange(len(h)))]
            else:
                windows = [(smaller, [s for s in SIZES if s <= room][-1], begin)]
            if len(h) >= REACH + SIZES[0] - 1 and size_of(len(h)) not in [size for _, size, _ in windows]:
                windows.append((found, size_of(len(h)), begin))
            for listed, size, places in windows:
                places = places[places + size <= len(h)]
                prints = fingerprints(sums, places, size)
                listed.setdefault(size, []).extend((int(p), k, int(b)) for p, b in zip(prints, places))
        edges = np.linspace(0, 64, rule.radius + 2).astype(int)
        self.cuts = [(np.uint64(a), np.uint64((1 << int(b - a)) - 1)) for a, b in zip(edges[:-1], edges[1:])]
        for listed, held in ((found, self.by_size), (smaller, self.smaller), (short, self.short)):
            for size, rows in listed.items():
                held[size] = self._tables(rows)

    def _tables(self, rows: list) -> tuple:
        prints = np.array([r[0] for r in rows], np.uint64)
        tables = []
        for shift, mask in self.cuts:
            value = (prints >> shift) & mask
            order = np.argsort(value, kind="stable")
            tables.append((value[order], order))
        return prints, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), tables

    def candidates(self, prints: np.ndarray, size: int, among: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(window, item fingerprint) of all pairs within the radius, each once. ``among``: the windows of one kind, by size."""
        own, _, _, tables = (self.by_size if among is None else among)[size]
        pairs = []
        for (shift, mask), (values, order) in zip(self.cuts, tables):
            value = (prints >> shift) & mask
            low, high = np.searchsorted(values, value), np.searchsorted(values, value, "right")
            hit = np.flatnonzero(high > low)
            if not len(hit):
                continue
            many = high[hit] - low[hit]
            window = np.repeat(hit, many)
            offset = np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many)
            other = order[np.repeat(low[hit], many) + offset]
            near = _distance(prints[window], own[other]) <= self.rule.radius
            pairs.append(window[near].astype(np.int64) * len(own) + other[near])
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.divmod(np.unique(np.concatenate(pairs)), len(own))


def weighted_shingles(hashes: np.ndarray, lengths: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and weight (letters of its words) of each run of ``k`` words; fewer words make one run."""
    k = min(k, len(hashes))
    if not k:
        return np.zeros(0, np.uint64), np.zeros(0)
    n = len(hashes) - k + 1
    h, w = hashes[:n].copy(), lengths[:n].astype(float)
    for j in range(1, k):
        h = mixed(h * np.uint64(0xBF58476D1CE4E5B9) + hashes[j : n + j])
        w = w + lengths[j : n + j]
    return h, w


def best_similarity(item: tuple, region: tuple, k: int) -> float:
    """Largest weighted Jaccard similarity of the item and a place of its length in the region."""
    k = min(k, len(item[0]))
    (ih, iw), (rh, rw) = weighted_shingles(*item, k), weighted_shingles(*region, k)
    if not len(ih) or not len(rh):
        return 0.0
    span = min(len(ih), len(rh))
    if not np.isin(rh, ih).any():
        return 0.0
    wanted, best = dict(), 0.0
    for h, w in zip(ih.tolist(), iw.tolist()):  # a shingle that repeats weighs as often as it stands there
        wanted[h] = wanted.get(h, 0.0) + w
    whole = sum(wanted.values())
    for a in range(len(rh) - span + 1):
        there: dict = {}
        for h, w in zip(rh[a : a + span].tolist(), rw[a : a + span].tolist()):
            there[h] = there.get(h, 0.0) + w
        both = sum(min(w, wanted[h]) for h, w in there.items() if h in wanted)
        best = max(best, both / (whole + sum(there.values()) - both))
    return best


def matches(texts: pa.Array, index: Index) -> list[tuple[int, int, float, int]]:
    """(text, item, similarity, first word of the window) of all texts against a block of items."""
    words = Words(texts)
    if not len(words.hash):
        return []
    begin = starts(words.hash, words.text)
    sums = running_signs(words.hash)
    lengths = words.end - words.start
    best: dict[tuple[int, int], tuple[float, int]] = {}
    tried = set()
    tables = [(size, among, begin) for among in (index.by_size, index.smaller) for size in among]
    tables += [(size, index.short, np.arange(len(words.hash))) for size in index.short]
    for size, among, places in tables:
        _, items, offsets, _ = among[size]
        fits = places[places + size <= len(words.hash)]
        fits = fits[words.text[fits] == words.text[fits + size - 1]]
        for a in range(0, len(fits), HELD_WINDOWS):
            at = fits[a : a + HELD_WINDOWS]
            window, other = index.candidates(fingerprints(sums, at, size), size, among)
            for w, o in zip(at[window].tolist(), other.tolist()):
                item, text = int(items[o]), int(words.text[w])
                guess = w - int(offsets[o])
                if (text, item, guess) in tried:
                    continue
                tried.add((text, item, guess))
                first, last = words.first[text], words.first[text + 1]
                margin = 2 + len(index.words[item]) // 8
                low, high = max(first, guess - margin), min(last, guess + len(index.words[item]) + margin)
                score = best_similarity(
                    (index.words[item], index.lengths[item]), (words.hash[low:high], lengths[low:high]), index.rule.shingle
                )
                if score >= index.rule.similarity and score > best.get((text, item), (0.0, 0))[0]:
                    best[text, item] = (score, int(max(guess, first) - first))
    return [(t, i, s, p) for (t, i), (s, p) in best.items()]


MATCH = "item_id bigint, similarity double, first_word bigint"


def _searcher(shared, kept):
    def search(batches):
        index = shared.value
        for batch in batches:
            for part in slices(batch, "_text", HELD_BYTES):
                found = matches(part.column("_text"), index)
                if found:
                    rows = pa.array([f[0] for f in found])
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[part.column(n).take(rows) for n in kept],
                            pa.array([index.ids[f[1]] for f in found], pa.int64()),
                            pa.array([round(f[2], 6) for f in found], pa.float64()),
                            pa.array([f[3] for f in found], pa.int64()),
                        ],
                        names=[*kept, "item_id", "similarity", "first_word"],
                    )

    return search


def item_blocks(benchmark: DataFrame):
    """Items in blocks of ``ITEM_BLOCK``: the query set comes to the driver block by block, the documents never do."""
    rows, block = benchmark.filter(F.length("text") > 0).select("item_id", "text").toLocalIterator(), []
    for r in rows:
        block.append((r.item_id, r.text))
        if len(block) == ITEM_BLOCK:
            yield block
            block = []
    if block:
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, rule: Matching = Matching(), text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each document and item found in it: ``keys``, item_id, similarity, first_word."""
    spark = docs.sparkSession
    source = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").cast("string").alias("_text"))
    schema = source.drop("_text").schema.add("item_id", "long").add("similarity", "double").add("first_word", "long")
    out = None
    for block in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(Index(block, rule))
        part = source.mapInArrow(_searcher(shared, list(keys)), schema)
        out = part if out is None else out.unionAll(part)
    return spark.createDataFrame([], schema) if out is None else out


def _cleaner(indexes, text):
    def clean(batches):
        for batch in batches:
            for part in slices(batch, text, HELD_BYTES):
                hit = {f[0] for shared in indexes for f in matches(part.column(text), shared.value)}
                rows = [k for k in range(part.num_rows) if k not in hit]
                if rows:
                    yield part if not hit else part.take(pa.array(rows))

    return clean


def decontaminate(docs: DataFrame, benchmark: DataFrame, rule: Matching = Matching(), text: str = "text") -> DataFrame:
    """The documents in which no item is found, with the columns they came with; nothing is shuffled."""
    indexes = [docs.sparkSession.sparkContext.broadcast(Index(b, rule)) for b in item_blocks(benchmark)]
    return docs.mapInArrow(_cleaner(indexes, text), docs.schema) if indexes else docs


@query("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, sf_dir, "benchmark"))
