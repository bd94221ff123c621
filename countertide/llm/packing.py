"""Best-fit packing of tokenised documents into sequences (operator 13).

A document's tokens end with a separator; longer documents than a sequence are cut from the end into full pieces, so
that the first piece alone may be shorter. Only piece lengths matter for packing, so it is planned on the histogram of
lengths, of fixed size at any corpus: lengths above a third of the capacity are matched first, two a sequence at most,
each from the largest on with the largest partner that fits; smaller lengths then go, largest first, into the tightest
gap that holds them, all pieces of a length at once. The plan is runs: the pieces of a length with ranks from r on go
to sequences from s on at one offset. Pieces are ranked within their length over blocks and look their run up.

Tokens: a byte-level BPE file of the ``tokenizers`` library. Its merges are run by ``tiktoken`` on ranks read from the same
file, which gives the same ids at three times the speed; texts that hold an added token's string are encoded by
``tokenizers`` itself.

Defined results: null and empty texts are a separator alone; very long texts are encoded whole and cut; repeated rows and
null ids are packed each (an id with several rows has several pieces of a number); rows of equal length share out places
in the order in which they are met; other columns are not looked at, whatever their names; an empty table gives no sequences.
"""

from __future__ import annotations

import base64
import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countertide.llm.common import slices, table
from countertide.llm.places import TASK_BITS, block_bits, places_in_class
from countertide.llm.registry import query
from countertide.plans.shared import freeze

CAPACITY = 2048
SEPARATOR = 0
#: Bits of a rank within a length.
_RANK_BITS = 48
#: Fixed value: how the byte-level BPE of this file splits text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be printed, else one from U+0100 on."""
    printed = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in set(printed)]
    return {chr(b): b for b in printed} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def _encoder(file: str):
    """``text -> ids`` of a tokenizer file's content."""
    import tiktoken
    from tokenizers import Tokenizer

    spec = json.loads(file)
    pre = spec["pre_tokenizer"]
    plain = spec["normalizer"] is None and pre["type"] == "ByteLevel" and not pre["add_prefix_space"] and pre.get("use_regex", True)
    if not plain or spec["model"]["type"] != "BPE" or spec["model"].get("ignore_merges"):
        raise ValueError("only byte-level BPE without normalisation is read")
    added = {t["content"] for t in spec["added_tokens"]}
    byte = _byte_letters()
    ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
    fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = Tokenizer.from_str(file)

    def encode(text: str) -> np.ndarray:
        if any(t in text for t in added):
            return np.array(whole.encode(text, add_special_tokens=False).ids, "<u4")
        return fast.encode_to_numpy(text).astype("<u4")

    return encode


def pieces(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """Per piece: the id, piece, start, length, ids_crc32, ``ids`` as packed unsigned 32-bit values, and ``_place``, where it was met.

    ``tokenizer`` is the path of a file on the driver.
    """
    with open(tokenizer, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    names = ["_id", "piece", "start", "length", "ids_crc32", "ids", "_place"]

    def run(batches):
        encode = _encoder(shared.value)
        place = TaskContext.get().partitionId() << TASK_BITS
        end = np.array([separator], "<u4")
        for batch in batches:
            for part in slices(batch, "_text"):
                row, number, start, length, crc, data = [], [], [], [], [], []
                for k, t in enumerate(part.column("_text")):
                    ids = np.concatenate([encode(t.as_py() or ""), end])
                    first = len(ids) % capacity or capacity
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        packed = ids[a:b].tobytes()
                        row.append(k)
                        number.append(p)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(packed))
                        data.append(packed)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id").take(pa.array(row, pa.int64())),
                        *[pa.array(c, t) for c, t in zip((number, start, length, crc), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                        pa.array(data, pa.binary()),
                        pa.array(place + np.arange(len(row))),
                    ],
                    names=names,
                )
                place += len(row)

    source = docs.select(F.col(f"`{id}`").cast("bigint").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    schema = "_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, _place bigint"
    return source.mapInArrow(run, schema).withColumnRenamed("_id", id)


class Plan:
    """Runs of a packing: pieces of ``length`` with ranks from ``first`` on lie at ``offset`` of the sequences from ``sequence`` on."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {s: n for s, n in counts.items() if n}
        self.used = dict.fromkeys(self.left, 0)
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int]] = []
        #: By gap: stretches of sequences (first, how many) that have it.
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self._match()
        self._fill()
        table = np.array(sorted(self.runs), np.int64).reshape(-1, 4)
        length, self.first, self.sequence, self.offset = table.T
        self.keys = (length << _RANK_BITS) | self.first

    def _put(self, size: int, many: int, sequence: int, offset: int) -> None:
        self.runs.append((size, self.used[size], sequence, offset))
        self.used[size] += many
        self.left[size] -= many

    def _open(self, many: int) -> int:
        self.sequences += many
        return self.sequences - many

    def _match(self) -> None:
        """Pair lengths over a third of the capacity: the largest left with the largest that fits beside it."""
        large = sorted((s for s in self.left if 3 * s > self.capacity), reverse=True)
        for size in large:
            for other in large:
                if other > size or other + size > self.capacity:
                    continue
                many = self.left[size] // 2 if other == size else min(self.left[size], self.left[other])
                if many:
                    at = self._open(many)
                    self._put(size, many, at, 0)
                    self._put(other, many, at, size)
                    self.gaps.setdefault(self.capacity - size - other, []).append((at, many))
            if self.left[size]:
                many = self.left[size]
                at = self._open(many)
                self._put(size, many, at, 0)
                self.gaps.setdefault(self.capacity - size, []).append((at, many))

    def _fill(self) -> None:
        """The other lengths, largest first, each into the tightest gap; new sequences where no gap is left."""
        for size in sorted((s for s, n in self.left.items() if n), reverse=True):
            while self.left[size]:
                gap = min((g for g in self.gaps if g >= size), default=None)
                if gap is None:
                    each = self.capacity // size
                    whole, rest = divmod(self.left[size], each)
                    for many, items in ((whole, each), (1 if rest else 0, rest)):
                        if many:
                            at = self._open(many)
                            for k in range(items):
                                self._put(size, many, at, k * size)
                            self.gaps.setdefault(self.capacity - items * size, []).append((at, many))
                    break
                at, many = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    del self.gaps[gap]
                # A sequence just begun upon stays the tightest one while it holds more of this length.
                each = min(gap // size, self.left[size])
                taken = min(many, self.left[size] // each)
                for k in range(each):
                    self._put(size, taken, at, self.capacity - gap + k * size)
                self.gaps.setdefault(gap - each * size, []).append((at, taken))
                if many > taken:
                    self.gaps.setdefault(gap, []).append((at + taken, many - taken))

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces by their length and their rank within it."""
        run = np.searchsorted(self.keys, (length << _RANK_BITS) | rank, "right") - 1
        return self.sequence[run] + rank - self.first[run], self.offset[run]


def assign(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Written ``cut`` pieces (``length``, ``_place``) with ``sequence_id`` and ``offset``.

    The plan has one run for each step over (length, gap), both at most ``capacity``: it grows with the capacity, not with the corpus.
    """
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    plan = spark.sparkContext.broadcast(Plan(counts, capacity))
    bits = block_bits(sum(counts.values()), int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranked = places_in_class(cut, F.col("length"), "_place", bits, "_rank")

    def run(batches):
        for b in batches:
            sequence, offset = plan.value.find(b.column("length").to_numpy(), b.column("_rank").to_numpy())
            kept = [n for n in b.schema.names if n not in ("_rank", "_place")]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in kept], pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    schema = ranked.drop("_rank", "_place").schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Per piece: the id, piece, start, length, ids_crc32, sequence_id, offset; ids are dropped."""
    return assign(freeze(pieces(docs, tokenizer, id, text, capacity).drop("ids"), "pieces"), capacity)


def sequences(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences: sequence_id and ``ids`` (packed unsigned 32-bit values), at most ``capacity`` of them."""
    placed = assign(freeze(pieces(docs, tokenizer, id, text, capacity), "pieces"), capacity)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    return joined.select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op13_best_fit")
def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), default_tokenizer())
