"""Gradient-boosted trees on binned features: Huber, squared, absolute and logistic loss, many settings in shared passes.

Features are cut once into bytes at borders from a mergeable quantile sketch, and rows are written as blocks of bytes. A
level of a tree needs one thing of the rows: sums of gradients, curvatures and counts by (fit, node, feature, bin). These
are whole numbers (gradients are rounded to 2 ** -20), so that their sums and with them all trees are the same however rows
are dealt over blocks, tasks and machines.

A tree is grown by a generator that asks for the histograms of its open nodes. With several blocks the driver asks for those
of all fits at once: one job a level for all settings and folds, as many as the deepest fit needs. With a single block, which
has ``BLOCK_ROWS`` rows at most, the same generators run where the block lies, one fit to a task, and no job is needed in
between. Folds are masks: a row of the fold that a fit leaves out has no weight in it.

Fits that are only compared leave their trees where they grow: the driver gets two counts of each (``held_out_counts``). Trees
of a chosen fit are written where they grow; above ``TREE_BYTES`` they stay a table, and rows meet them there (``StoredTrees``).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Generator, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, fields
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countertide.plans.ordered import running_totals
from countertide.plans.shared import fresh_path, freeze, read_back

BLOCK_ROWS = 1 << 20
BINS = 64
#: Open nodes whose histograms are asked for at a time.
OPEN_NODES = 512
#: Rounds after which margins are written, so that a lost block replays few trees.
KEPT_ROUNDS = 10
#: Rows from which on symmetric trees are grown by halves and joined features.
ROWS_TO_JOIN = 1 << 14
#: Distinct categories that the table of target means may hold.
CATEGORIES = 100_000
SKETCH = 10_000
#: Bytes of trees that the driver and a task hold at a time; a larger fit stays a written table.
TREE_BYTES = 16 << 20
#: Combinations of bins that meet a part of the written trees in one task.
CELLS = 1 << 18
_UNIT = float(1 << 20)
#: Rows whose histogram is added up at a time, so that they stay in a core's cache.
_ROWS_AT_ONCE = 1 << 15
#: Types of a finished tree's arrays.
_TYPES = {"feature": np.int16, "border": np.uint8, "left": np.int32, "right": np.int32, "value": np.float64, "gain": np.float64}


@dataclass(frozen=True)
class Setting:
    """How one ensemble is fitted. ``symmetric``: a level has one split for all its nodes. ``fold``: rows to leave out."""

    rounds: int = 100
    depth: int = 6
    rate: float = 0.1
    leaf_penalty: float = 1.0
    min_rows: int = 1
    loss: str = "squared"
    symmetric: bool = False
    fold: int = -1


@dataclass(eq=False)
class Tree:
    """Nodes as lists while it grows, as arrays when it is packed; a feature of -1 marks a leaf. Rows with a bin up to ``border`` go left."""

    feature: Sequence[int] = field(default_factory=lambda: [-1])
    border: Sequence[int] = field(default_factory=lambda: [0])
    left: Sequence[int] = field(default_factory=lambda: [0])
    right: Sequence[int] = field(default_factory=lambda: [0])
    value: Sequence[float] = field(default_factory=lambda: [0.0])
    gain: Sequence[float] = field(default_factory=lambda: [0.0])

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Tree) and all(np.array_equal(getattr(self, c), getattr(other, c)) for c in _TYPES)

    def packed(self) -> Tree:
        """The same tree as arrays: 27 bytes a node."""
        return Tree(**{c: np.array(getattr(self, c), t) for c, t in _TYPES.items()})

    def plain(self) -> dict[str, list]:
        """Lists by name, for JSON."""
        return {c: np.asarray(getattr(self, c)).tolist() for c in _TYPES}

    def to_bytes(self) -> bytes:
        return b"".join(np.array(getattr(self, c), t).tobytes() for c, t in _TYPES.items())

    @staticmethod
    def from_bytes(raw: bytes) -> Tree:
        nodes = len(raw) // sum(np.dtype(t).itemsize for t in _TYPES.values())
        out, at = {}, 0
        for c, t in _TYPES.items():
            out[c] = np.frombuffer(raw, t, nodes, at)
            at += out[c].nbytes
        return Tree(**out)

    def split(self, node: int, feature: int, border: int, gain: float, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.border[node], self.gain[node] = feature, border, gain
        ends = []
        for v in values:
            ends.append(len(self.feature))
            for name, x in (("feature", -1), ("border", 0), ("left", 0), ("right", 0), ("value", v), ("gain", 0.0)):
                getattr(self, name).append(x)
        self.left[node], self.right[node] = ends
        return ends[0], ends[1]

    def levels(self) -> list[tuple[int, int]] | None:
        """(feature, border) by level of a tree that splits all nodes of a level alike, each node into 2k + 1 and 2k + 2; else none."""
        feature, border = np.asarray(self.feature), np.asarray(self.border)
        inner = np.flatnonzero(feature >= 0)
        if len(inner) != len(feature) // 2 or (len(inner) and inner[-1] != len(inner) - 1):
            return None
        if not (np.array_equal(np.asarray(self.left)[inner], 2 * inner + 1) and np.array_equal(np.asarray(self.right)[inner], 2 * inner + 2)):
            return None
        out, first = [], 0
        while first < len(inner):
            alike = slice(first, 2 * first + 1)
            if (feature[alike] != feature[first]).any() or (border[alike] != border[first]).any():
                return None
            out.append((int(feature[first]), int(border[first])))
            first = 2 * first + 1
        return out

    def nodes(self, bins: np.ndarray, alike: list[tuple[int, int]] | None = None) -> np.ndarray:
        """The leaf of each row; ``alike`` are the tree's ``levels`` if they are known already."""
        at = np.zeros(len(bins), np.int64)
        alike = self.levels() if alike is None else alike
        if alike is not None:
            # The number of a leaf has one bit more than the tree has levels; few bits are shifted many rows at a time.
            side = np.zeros(len(bins), np.uint8 if len(alike) < 8 else np.int64)
            for f, border in alike:
                side <<= 1
                side |= bins[:, f] > border
            return side + side.dtype.type((1 << len(alike)) - 1)
        feature, border = np.asarray(self.feature), np.asarray(self.border)
        left, right = np.asarray(self.left), np.asarray(self.right)
        rows = np.flatnonzero(feature[at] >= 0)
        while len(rows):
            here = at[rows]
            low = bins[rows, feature[here]] <= border[here]
            here = np.where(low, left[here], right[here])
            at[rows] = here
            rows = rows[feature[here] >= 0]
        return at


class StoredTrees(Sequence[Tree]):
    """The trees of a fit as a written table (turn, tree) with their bytes by turn. Iterating reads one after the other."""

    def __init__(self, table: DataFrame, sizes: Sequence[int]):
        self.table, self.sizes = table, list(sizes)

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, turn: int) -> Tree:
        turn = range(len(self))[turn]
        return Tree.from_bytes(bytes(self.table.filter(F.col("turn") == turn).head()["tree"]))

    def __iter__(self) -> Iterator[Tree]:
        return (self[turn] for turn in range(len(self)))

    def part_of_turn(self) -> list[int]:
        """Consecutive trees make a part of about ``TREE_BYTES``."""
        return [(end - size) // TREE_BYTES for end, size in zip(accumulate(self.sizes), self.sizes)]

    def gains(self, features: int) -> np.ndarray:
        """Gains of all splits by input, added up by tree where the trees lie."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = [_gains(Tree.from_bytes(raw.as_py()), features).tolist() for raw in b.column("tree")]
                yield pa.RecordBatch.from_arrays([b.column("turn"), pa.array(rows, pa.list_(pa.float64()))], names=["turn", "gains"])

        rows = self.table.mapInArrow(run, "turn int, gains array<double>").collect()  # a few numbers for each tree
        return np.sum([r["gains"] for r in sorted(rows, key=lambda r: r["turn"])], axis=0)


def _gains(tree: Tree, features: int) -> np.ndarray:
    out = np.zeros(features)
    split = np.flatnonzero(np.asarray(tree.feature) >= 0)
    np.add.at(out, np.asarray(tree.feature)[split], np.asarray(tree.gain)[split])
    return out


def slopes(loss: str, margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole-number gradients and curvatures of the loss."""
    if loss == "logistic":
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1.0 - p)
    else:
        miss = margin - y
        g = w * (np.clip(miss, -1.0, 1.0) if loss == "huber" else np.sign(miss) if loss == "absolute" else miss)
        h = w
    return np.rint(g * _UNIT), np.rint(h * _UNIT)


def columns_of(bins: np.ndarray) -> np.ndarray:
    """Bins by feature."""
    return np.ascontiguousarray(bins.T)


def histograms(columns: np.ndarray, at: np.ndarray, sums: Sequence[np.ndarray], nodes: int, width: int) -> np.ndarray:
    """(gradient, curvature, count) by (node, feature, bin) of rows at nodes 0 to ``nodes`` - 1.

    Gradients and counts are whole numbers. Where those of some thousand rows fit one float together, they are added up
    together: the count stands above all digits that the gradients can reach.
    """
    g, h, used = sums
    features, size = len(columns), nodes * width
    top = float(np.abs(g).max(initial=1.0))
    bits = int(top).bit_length() if np.isfinite(top) else 64
    step = 1 << min(_ROWS_AT_ONCE.bit_length() - 1, max(0, (52 - bits) // 2))
    above = None
    if step >= 1 << 12:
        above = float(1 << (bits + step.bit_length()))
        g = g + used * above
    else:
        step = _ROWS_AT_ONCE
    counts_only = np.array_equal(h, used * _UNIT)
    out = np.zeros((3, features, nodes, width), np.int64)
    for first in range(0, len(at), step):
        part = slice(first, first + step)
        start = at[part] * width
        group = max(1, min(features, _ROWS_AT_ONCE // len(start)))
        for f in range(0, features, group):
            among = min(group, features - f)
            flat = (columns[f : f + among, part] + start).ravel()
            if among > 1:
                flat += np.repeat(np.arange(0, among * size, size), len(start))

            def added(s: np.ndarray) -> np.ndarray:
                return np.bincount(flat, s[part] if among == 1 else np.tile(s[part], among), among * size)

            total = added(g)
            if above:
                n = np.rint(total / above)
                total -= n * above
            else:
                n = added(used)
            sums_here = (total, None if counts_only else added(h), n)
            for k, s in enumerate(sums_here):
                if s is not None:
                    out[k, f : f + among] += s.astype(np.int64).reshape(among, nodes, width)
    if counts_only:
        out[1] = out[2] * int(_UNIT)
    return out.transpose(0, 2, 1, 3)


def places(node: np.ndarray, open_nodes: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are at open nodes, and the place of their node among these."""
    place = np.full(max(int(node.max(initial=0)), *open_nodes) + 1, -1)
    place[list(open_nodes)] = np.arange(len(open_nodes))
    at = place[node]
    rows = np.flatnonzero(at >= 0)
    return rows, at[rows]


Steps = Generator[tuple[Tree, list[int]], np.ndarray, Tree]


def grow(setting: Setting) -> Steps:
    """One tree: yields itself and open nodes, is sent their histograms, returns the tree."""
    tree, level = Tree(), [0]
    penalty = setting.leaf_penalty

    def value(g, h) -> float:
        return float(-setting.rate * g / (h + penalty)) if h + penalty > 0 else 0.0

    for depth in range(setting.depth):
        following: list[int] = []
        for first in range(0, len(level), OPEN_NODES):
            nodes = level[first : first + OPEN_NODES]
            answer = yield tree, nodes
            left = np.cumsum(answer, axis=3)
            lg, lh, ln = left[0, :, :, :-1] / _UNIT, left[1, :, :, :-1] / _UNIT, left[2, :, :, :-1]
            tg, th, tn = (x / u for x, u in zip(left[:, :, :1, -1:], (_UNIT, _UNIT, 1)))
            if not depth:
                tree.value[0] = value(tg[0, 0, 0], th[0, 0, 0])
            rg, rh, rn = tg - lg, th - lh, tn - ln
            floor = penalty if penalty > 0 else 1e-12
            score = lg * lg / (lh + floor) + rg * rg / (rh + floor) - tg * tg / (th + floor)
            if setting.symmetric:
                score = score.sum(axis=0, keepdims=True)
            else:
                score = np.where((ln >= setting.min_rows) & (rn >= setting.min_rows), score, -1.0)
            flat = score.reshape(len(score), -1)
            best = flat.argmax(axis=1)
            for k, node in enumerate(nodes):
                row = 0 if setting.symmetric else k
                gain = float(flat[row, best[row]])
                if gain <= 1e-9:
                    continue
                f, b = divmod(int(best[row]), score.shape[2])
                ends = tree.split(node, f, b, gain / (len(nodes) if setting.symmetric else 1), (value(lg[k, f, b], lh[k, f, b]), value(rg[k, f, b], rh[k, f, b])))
                for end, rows in zip(ends, (ln[k, f, b], rn[k, f, b])):
                    if rows >= (0 if setting.symmetric else 2 * setting.min_rows):
                        following.append(end)
        level = following
        if not level:
            break
    return tree


def _advance(steps: Steps, answer: np.ndarray | None) -> tuple[Tree, list[int] | None]:
    """The next request of a growing tree; no nodes when it is done."""
    try:
        return next(steps) if answer is None else steps.send(answer)
    except StopIteration as done:
        return done.value, None


@dataclass
class Block:
    """Rows of a block as arrays."""

    bins: np.ndarray
    y: np.ndarray
    w: np.ndarray
    fold: np.ndarray
    margin: np.ndarray

    def sums(self, setting: Setting, margin: np.ndarray) -> list[np.ndarray]:
        w = np.where(self.fold == setting.fold, 0.0, self.w)
        return [*slopes(setting.loss, margin, self.y, w), (w > 0).astype(float)]


SCHEMA = "n bigint, bins binary, y binary, w binary, fold binary, margin binary"


def _unpack(row: Mapping) -> Block:
    n = row["n"]
    return Block(
        np.frombuffer(row["bins"], np.uint8).reshape(n, -1),
        *(np.frombuffer(row[c]) for c in ("y", "w")),
        np.frombuffer(row["fold"], np.int32),
        np.frombuffer(row["margin"]).reshape(-1, n),
    )


def _fit_block(block: Block, setting: Setting, width: int, keep: Callable[[Tree], None]) -> np.ndarray:
    """All rounds of one fit on the only block; its margins."""
    margin = block.margin[0].copy()
    for tree, margin in _rounds(block, setting, width):
        keep(tree)
    return margin


def _rounds(block: Block, setting: Setting, width: int) -> Iterator[tuple[Tree, np.ndarray]]:
    """Each tree of one fit on the only block, and the margins after it."""
    margin = block.margin[0].copy()
    columns = columns_of(block.bins)
    # Few rows are added up faster than halves are told apart.
    alike = setting.symmetric and 2 ** (setting.depth - 1) <= OPEN_NODES and columns.shape[1] >= ROWS_TO_JOIN
    joint = JointSums(columns, width) if alike else None
    for _ in range(setting.rounds):
        sums = block.sums(setting, margin)
        tree, at = _grow_alike(columns, joint, sums, setting) if joint else _grow_on(columns, sums, setting, width)
        margin = margin + np.array(tree.value)[at]
        yield tree, margin


def _grow_on(columns: np.ndarray, sums: Sequence[np.ndarray], setting: Setting, width: int) -> tuple[Tree, np.ndarray]:
    """One tree over rows at hand, and the leaf of each row.

    Open nodes are asked for in the order of their numbers. Where a level is asked for in several turns, its rows are
    sorted by node once, so that each turn reads its own rows only.
    """
    n_rows = columns.shape[1]
    steps = grow(setting)
    tree, nodes = _advance(steps, None)
    at = np.zeros(n_rows, np.int64)
    last, rows, order, sorted_at, all_split = -1, np.arange(n_rows), None, None, True
    while nodes is not None:
        low, high = nodes[0], nodes[-1]
        if low > last:  # a new level: its nodes have higher numbers than all before
            active = rows if all_split else np.flatnonzero(at > last)
            all_open = list(nodes) == list(range(last + 1, len(tree.feature)))
            last = len(tree.feature) - 1
            if len(nodes) < OPEN_NODES:
                order, rows = None, active
            else:
                order = active[np.argsort(at[active], kind="stable")]
                sorted_at = at[order]
        if order is not None:
            rows = order[np.searchsorted(sorted_at, low) : np.searchsorted(sorted_at, high, "right")]
        whole = order is None and len(rows) == n_rows
        here = (at if whole else at[rows]) - low
        now = here
        if not all_open:
            place = np.full(last + 1 - low, -1)
            place[np.array(nodes) - low] = np.arange(len(nodes))
            now = np.where(here >= 0, place[np.maximum(here, 0)], -1)
            inside = np.flatnonzero(now >= 0)
            if len(inside) < len(rows):
                rows, here, now, whole = rows[inside], here[inside], now[inside], False
        mine = columns if whole else columns[:, rows]
        parts = sums if whole else [s[rows] for s in sums]
        tree, following = _advance(steps, histograms(mine, now, parts, len(nodes), width))
        feature, border = np.array(tree.feature[low : high + 1]), np.array(tree.border[low : high + 1])
        left, right = np.array(tree.left[low : high + 1]), np.array(tree.right[low : high + 1])
        all_split = all_open and (feature >= 0).all()
        if setting.symmetric and whole and all_split:
            at = left[here] + (mine[feature[0]] > border[0])  # the right end follows the left one
        else:
            f = feature[here]
            moved = np.flatnonzero(f >= 0)
            here = here[moved]
            under = mine[f[moved], moved] <= border[here]
            at[rows[moved]] = np.where(under, left[here], right[here])
        nodes = following
    return tree, at


@dataclass
class Cells:
    """Features that have few combinations of bins together: the combination of each row, and the bin of a feature in each combination."""

    of_row: np.ndarray
    bins: dict[int, np.ndarray]


def joint_cells(columns: np.ndarray) -> list[Cells]:
    """All features, joined in their order as long as the combinations that occur fit a byte (hour and weekday, say).

    A histogram over combinations holds those of all its features, so rows are read once for several features.
    """
    out: list[Cells] = []
    for f, column in enumerate(columns):
        for known in out:
            pair = known.of_row.astype(np.int32) << 8 | column
            present = np.flatnonzero(np.bincount(pair, minlength=1 << 16))
            if len(present) <= 256:
                number = np.zeros(1 << 16, np.uint8)
                number[present] = np.arange(len(present))
                known.of_row = number[pair]
                known.bins = {g: b[present >> 8] for g, b in known.bins.items()} | {f: (present & 255).astype(np.uint8)}
                break
        else:
            present = np.flatnonzero(np.bincount(column, minlength=256))
            number = np.zeros(256, np.uint8)
            number[present] = np.arange(len(present))
            out.append(Cells(number[column], {f: present.astype(np.uint8)}))
    return out


class JointSums:
    """Histograms of features from those of their combinations. What stays the same over all trees is looked up once."""

    def __init__(self, columns: np.ndarray, width: int):
        cells = joint_cells(columns)
        self.of_row = np.stack([c.of_row for c in cells])
        self.deepest = max(len(next(iter(c.bins.values()))) for c in cells)
        self.shape = (len(columns), width)
        self.ways = []
        for k, c in enumerate(cells):
            for f, bins in c.bins.items():
                order = np.argsort(bins, kind="stable")
                present, first = np.unique(bins[order], return_index=True)
                self.ways.append((k, f, present, None if len(c.bins) == 1 else (order, first)))

    def sums(self, rows: np.ndarray | None, at: np.ndarray, sums: Sequence[np.ndarray], nodes: int) -> np.ndarray:
        """(gradient, curvature, count) by (feature, node, bin) of all or some rows."""
        mine = self.of_row if rows is None else self.of_row[:, rows]
        joined = histograms(mine, at, sums if rows is None else [s[rows] for s in sums], nodes, self.deepest)
        features, width = self.shape
        out = np.zeros((3, features, nodes, width), np.int64)
        for k, f, present, order in self.ways:
            here = joined[:, :, k]
            out[:, f, :, present] = np.moveaxis(here[:, :, : len(present)] if order is None else np.add.reduceat(here[:, :, order[0]], order[1], axis=2), 2, 0)
        return out


def _grow_alike(columns: np.ndarray, joint: JointSums, sums: Sequence[np.ndarray], setting: Setting) -> tuple[Tree, np.ndarray]:
    """One symmetric tree over rows at hand, and the leaf of each row.

    Below the root only the smaller half of each split node is added up; the other half is what the node has besides it.
    """
    steps = grow(setting)
    tree, nodes = _advance(steps, None)
    at = np.zeros(columns.shape[1], np.int64)
    known, first = None, 0
    while nodes is not None:
        if known is None:
            known = joint.sums(None, at, sums, 1)
        else:
            sizes = np.bincount(at, minlength=len(nodes))
            half = np.where(sizes[1::2] < sizes[::2], 1, 0)
            rows = np.flatnonzero((at & 1) == half[at >> 1])
            few = joint.sums(rows, at[rows] >> 1, sums, len(half))
            place = 2 * np.arange(len(half)) + half
            both = np.empty((3, len(columns), len(nodes), few.shape[3]), np.int64)
            both[:, :, place] = few
            both[:, :, place ^ 1] = known - few
            known = both
        tree, following = _advance(steps, known.transpose(0, 2, 1, 3))
        f = tree.feature[first]
        if f >= 0:
            at = 2 * at + (columns[f] > tree.border[first])
            first = 2 * first + 1
        nodes = following
    return tree, at + first


def _one_task_a_fit(blocks: DataFrame, fits: int) -> DataFrame:
    """The only block once for each fit, each in a partition of its own."""
    each = blocks.withColumn("fit", F.explode(F.sequence(F.lit(0), F.lit(fits - 1))))
    return each.repartitionByRange(fits, "fit")


TREES = "fit int, turn int, tree binary"


def fit_blocks(blocks: DataFrame, n_blocks: int, settings: Sequence[Setting], width: int) -> list[Sequence[Tree]]:
    """The trees of each setting over written blocks: in the driver up to ``TREE_BYTES`` a setting, else as a written table."""
    if n_blocks <= 1:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for row in b.to_pylist():
                    for turn, (tree, _) in enumerate(_rounds(_unpack(row), settings[row["fit"]], width)):
                        columns = [pa.array([row["fit"]], pa.int32()), pa.array([turn], pa.int32()), pa.array([tree.to_bytes()], pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, names=["fit", "turn", "tree"])

        written = freeze(_one_task_a_fit(blocks, len(settings)).mapInArrow(run, TREES), "trees")
    else:
        written = _written_turns(blocks, settings, width)
    sizes: list[dict[int, int]] = [{} for _ in settings]
    for r in written.select("fit", "turn", F.length("tree").alias("size")).collect():
        sizes[r["fit"]][r["turn"]] = r["size"]
    small = [k for k, by_turn in enumerate(sizes) if sum(by_turn.values()) <= TREE_BYTES]
    out: list[Sequence[Tree]] = []
    for k, by_turn in enumerate(sizes):
        mine = written.filter(F.col("fit") == k).select("turn", "tree")
        if k in small:
            out.append([Tree.from_bytes(bytes(r["tree"])) for r in sorted(mine.collect(), key=lambda r: r["turn"])])
        else:
            out.append(StoredTrees(mine, [by_turn[turn] for turn in sorted(by_turn)]))
    return out


def _written_turns(blocks: DataFrame, settings: Sequence[Setting], width: int) -> DataFrame:
    """The trees over several blocks as a table, written whenever the driver holds ``TREE_BYTES`` of them."""
    spark, path = blocks.sparkSession, fresh_path(blocks.sparkSession, "trees")
    schema = spark.createDataFrame([], TREES).schema
    held: list[tuple[int, int, bytes]] = []

    def write() -> None:
        spark.createDataFrame(held, schema).write.mode("append").parquet(path)
        held.clear()

    for number, turn in enumerate(_turns(blocks, settings, width)):
        for k, tree in turn.trees.items():
            held.append((k, number, tree.to_bytes()))
            if sum(len(raw) for _, _, raw in held) > TREE_BYTES:
                write()
    write()
    return read_back(spark, path, schema)


@dataclass
class Turn:
    """What one round of all fits has brought: a tree of each fit that still grows, the blocks as last written, all trees since."""

    trees: dict[int, Tree]
    blocks: DataFrame
    since: list[list[Tree]]


def _turns(blocks: DataFrame, settings: Sequence[Setting], width: int) -> Iterator[Turn]:
    """All rounds over several blocks, one job a level for all fits. Trees whose margins are written are let go."""
    since: list[list[Tree]] = [[] for _ in settings]
    for turn in range(max(s.rounds for s in settings)):
        if turn and turn % KEPT_ROUNDS == 0:
            blocks = freeze(_with_margins(blocks, since, len(settings)), "boosting")
            since = [[] for _ in settings]
        growing = {k: grow(s) for k, s in enumerate(settings) if turn < s.rounds}
        asked = {k: _advance(g, None) for k, g in growing.items()}
        while any(nodes is not None for _, nodes in asked.values()):
            wanted, room = {}, OPEN_NODES
            for k, (tree, nodes) in asked.items():
                if nodes is not None and (not wanted or len(nodes) <= room):
                    wanted[k] = (tree, nodes)
                    room -= len(nodes)
            answers = _asked_histograms(blocks, settings, since, wanted, width)
            for k in wanted:
                asked[k] = _advance(growing[k], answers[k])
        for k, (tree, _) in asked.items():
            since[k].append(tree.packed())
        yield Turn({k: tree for k, (tree, _) in asked.items()}, blocks, since)


def _counts(block: Block, margin: np.ndarray, setting: Setting) -> list[int]:
    """Rows of class 1 that are found, and rows found plus rows of class 1, in the fold that the fit leaves out."""
    out = block.fold == setting.fold
    found, true = out & (margin > 0), out & (block.y == 1.0)
    return [int((found & true).sum()), int(found.sum() + true.sum())]


COUNTS = "fit int, hits bigint, found_or_true bigint"


def held_out_counts(blocks: DataFrame, n_blocks: int, settings: Sequence[Setting], width: int) -> list[tuple[int, int]]:
    """(hits, found + true) of each fit on its own fold. Trees stay where they grow; with several blocks the driver holds ``KEPT_ROUNDS`` of each."""
    if n_blocks <= 1:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for row in b.to_pylist():
                    block, setting = _unpack(row), settings[row["fit"]]
                    counts = _counts(block, _fit_block(block, setting, width, lambda t: None), setting)
                    yield pa.RecordBatch.from_arrays([pa.array([row["fit"]], pa.int32()), *[pa.array([c], pa.int64()) for c in counts]], names=["fit", "hits", "found_or_true"])

        counted = _one_task_a_fit(blocks, len(settings)).mapInArrow(run, COUNTS)
    else:
        last = Turn({}, blocks, [[] for _ in settings])
        for last in _turns(blocks, settings, width):
            pass
        since = last.since

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for row in b.to_pylist():
                    block = _unpack(row)
                    counts = [_counts(block, _margins(block, since, k), s) for k, s in enumerate(settings)]
                    columns = [pa.array(range(len(settings)), pa.int32()), *[pa.array(c, pa.int64()) for c in zip(*counts)]]
                    yield pa.RecordBatch.from_arrays(columns, names=["fit", "hits", "found_or_true"])

        counted = last.blocks.mapInArrow(run, COUNTS)
    summed = counted.groupBy("fit").agg(F.sum("hits").alias("hits"), F.sum("found_or_true").alias("found_or_true"))
    known = {r["fit"]: (r["hits"], r["found_or_true"]) for r in summed.collect()}  # two counts for each setting
    return [known.get(k, (0, 0)) for k in range(len(settings))]


def _margins(block: Block, since: Sequence[Sequence[Tree]], k: int) -> np.ndarray:
    margin = block.margin[min(k, len(block.margin) - 1)].copy()
    for t in since[k]:
        margin = margin + np.array(t.value)[t.nodes(block.bins)]
    return margin


def _with_margins(blocks: DataFrame, since: Sequence[Sequence[Tree]], fits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                block = _unpack(row)
                row["margin"] = np.concatenate([_margins(block, since, k) for k in range(fits)]).tobytes()
                yield pa.RecordBatch.from_pylist([row], schema=b.schema)

    return blocks.mapInArrow(run, SCHEMA)


def _asked_histograms(blocks: DataFrame, settings: Sequence[Setting], since, wanted, width: int) -> dict[int, np.ndarray]:
    """One job: the histograms of all wanted nodes, added up over blocks in a tree of tasks."""

    def local(row) -> dict[int, np.ndarray]:
        block = _unpack(row)
        columns = columns_of(block.bins)
        out = {}
        for k, (tree, nodes) in wanted.items():
            rows, at = places(tree.nodes(block.bins), nodes)
            sums = block.sums(settings[k], _margins(block, since, k))
            mine, parts = (columns, sums) if len(rows) == len(block.y) else (columns[:, rows], [s[rows] for s in sums])
            out[k] = histograms(mine, at, parts, len(nodes), width)
        return out

    def add(a, b):
        return {k: a[k] + b[k] for k in a}

    return blocks.rdd.map(local).treeReduce(add)


# ---------------------------------------------------------------- tables


def quantile_borders(df: DataFrame, names: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Up to ``bins - 1`` borders for each feature from one sketch; NaN and null count as the lowest value."""
    shares = [k / bins for k in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, SKETCH).alias(c) for c in names]).head()
    return [sorted({float(v) for v in row[c] or [] if v is not None and np.isfinite(v)}) for c in names]


def _bins(columns: Sequence[np.ndarray], borders: Sequence[Sequence[float]]) -> np.ndarray:
    """Number of borders below each value: a value on a border stays to its left."""
    out = [np.searchsorted(np.array(b), np.nan_to_num(c, nan=-np.inf, posinf=np.inf, neginf=-np.inf), "left") for c, b in zip(columns, borders)]
    # A feature's bins lie together, as trees read one feature after the other.
    return np.asfortranarray(np.column_stack(out).astype(np.uint8))


def make_blocks(df: DataFrame, names: Sequence[str], borders: Sequence[Sequence[float]], base: float, block_rows: int) -> tuple[DataFrame, int]:
    """Rows (names, _y, _w, _fold) as written blocks of at most ``block_rows``, and their number."""
    plain = df.select(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(f"_{k}") for k, c in enumerate(names)], "_y", "_w", "_fold")
    parts = max(1, -(-plain.count() // block_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def block():
            t = pa.Table.from_batches(held)
            cut = [t.column(k).to_numpy() for k in range(len(names))]
            y, w = (t.column(c).to_numpy().astype(float) for c in ("_y", "_w"))
            fold = t.column("_fold").to_numpy().astype(np.int32)
            cells = [t.num_rows, _bins(cut, borders).tobytes(), y.tobytes(), w.tobytes(), fold.tobytes(), np.full(len(y), base).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([c]) for c in cells], names=["n", "bins", "y", "w", "fold", "margin"])

        for b in batches:
            for at in range(0, b.num_rows, block_rows):
                piece = b.slice(at, block_rows)
                if rows and rows + piece.num_rows > block_rows:
                    yield block()
                    held, rows = [], 0
                held.append(piece)
                rows += piece.num_rows
        if rows:
            yield block()

    written = freeze(plain.repartition(parts).mapInArrow(run, SCHEMA), "blocks")
    return written, written.count()


@dataclass
class Boosted:
    """A fitted ensemble: its inputs, borders, trees, and the target means of its category if it has one."""

    names: tuple[str, ...]
    borders: list[list[float]]
    trees: Sequence[Tree]
    base: float
    loss: str
    category: str | None = None
    means: dict[str, float] = field(default_factory=dict)
    prior: float = 0.0

    def to_json(self) -> str:
        own = {f.name: getattr(self, f.name) for f in fields(self)}
        return json.dumps({**own, "trees": [t.plain() for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> Boosted:
        read = json.loads(text)
        return Boosted(**{**read, "names": tuple(read["names"]), "trees": [Tree(**t).packed() for t in read["trees"]]})

    @property
    def importances(self) -> np.ndarray:
        """Share of each input in the gains of all splits."""
        if isinstance(self.trees, StoredTrees):
            out = self.trees.gains(len(self.names))
        else:
            out = np.zeros(len(self.names))
            for t in self.trees:
                split = np.flatnonzero(np.asarray(t.feature) >= 0)
                np.add.at(out, np.asarray(t.feature)[split], np.asarray(t.gain)[split])
        return out / out.sum() if out.sum() else out

    def margin(self, bins: np.ndarray, levels: Sequence[list[tuple[int, int]] | None] | None = None) -> np.ndarray:
        """Sum of all trees; ``levels`` are those of the trees, for callers with many batches."""
        total = np.full(len(bins), self.base)
        for t, alike in zip(self.trees, levels or [None] * len(self.trees)):
            total += np.take(np.asarray(t.value), t.nodes(bins, alike))
        return total

    def encoded(self, df: DataFrame) -> DataFrame:
        """Inputs as doubles under ``_in_`` names, the category by its mean."""
        out = {}
        for c in self.names:
            if c == self.category:
                known = F.create_map(*[F.lit(x) for kv in self.means.items() for x in kv]) if self.means else None
                key = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
                value = F.lit(self.prior) if known is None else F.coalesce(F.try_element_at(known, key), F.lit(self.prior))
            else:
                value = F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan")))
            out[f"_in_{c}"] = value
        return df.withColumns(out)

    def transform(self, df: DataFrame, margin: str = "margin") -> DataFrame:
        """``df`` with the margin; for logistic loss also ``prediction`` and ``probability`` (a vector of both classes)."""
        ready = self.encoded(df)
        inputs = [f"_in_{c}" for c in self.names]
        if isinstance(self.trees, StoredTrees):
            scored = self._meeting_trees(ready, inputs, margin).drop(*inputs)
        else:
            scored = self._walked(ready, inputs, margin).drop(*inputs)
        if self.loss != "logistic":
            return scored
        p = 1.0 / (1.0 + F.exp(-F.col(margin)))
        return scored.withColumn("prediction", (p > 0.5).cast("double")).withColumn("probability", array_to_vector(F.array(1.0 - p, p)))

    def _walked(self, ready: DataFrame, inputs: Sequence[str], margin: str) -> DataFrame:
        """Margins by trees that each task holds."""
        shared = ready.sparkSession.sparkContext.broadcast(self)

        def walk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            model = shared.value
            levels = [t.levels() for t in model.trees]
            for part in parts:
                bins = _bins([part[c].to_numpy() for c in part], model.borders)
                yield pd.Series(model.margin(bins, levels))

        return ready.withColumn(margin, F.pandas_udf(walk, "double")(F.struct(*inputs)))

    def _meeting_trees(self, ready: DataFrame, inputs: Sequence[str], margin: str) -> DataFrame:
        """Margins by written trees. A margin depends on the bins alone, so distinct combinations of bins are dealt over tasks, each of
        which walks them through one part of the trees; sums of parts are added in their order and joined back by the bins."""
        borders, width = self.borders, len(self.names)

        def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for part in parts:
                raw = _bins([part[c].to_numpy() for c in part], borders).tobytes("C")
                yield pd.Series([raw[at : at + width] for at in range(0, len(raw), width)], dtype=object)

        def walk(cells: pa.Table, trees: pa.Table) -> pa.Table:
            total = np.zeros(cells.num_rows)
            if cells.num_rows:
                bins = np.asfortranarray(np.frombuffer(b"".join(cells.column("_bins").to_pylist()), np.uint8).reshape(-1, width))
                order = np.argsort(trees.column("turn").to_numpy())
                for k in order:
                    t = Tree.from_bytes(trees.column("tree")[int(k)].as_py())
                    total += np.take(t.value, t.nodes(bins))
            return pa.table({"_bins": cells.column("_bins"), "part": cells.column("part"), "sum": pa.array(total)})

        keyed = ready.withColumn("_bins", F.pandas_udf(cut, "binary")(F.struct(*inputs)))
        cells = freeze(keyed.select("_bins").distinct(), "cells")
        blocks = max(1, -(-cells.count() // CELLS))
        part_of_turn = self.trees.part_of_turn()
        parts = sorted(set(part_of_turn))
        dealt = cells.withColumns({"block": F.pmod(F.xxhash64("_bins"), F.lit(blocks)), "part": F.explode(F.array(*[F.lit(p) for p in parts]))})
        told = self.trees.table.withColumn("part", F.array(*[F.lit(p) for p in part_of_turn])[F.col("turn")])
        told = told.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
        sums = dealt.groupBy("block", "part").cogroup(told.groupBy("block", "part")).applyInArrow(walk, "_bins binary, part int, sum double")
        ordered = F.array_sort(F.collect_list(F.struct("part", "sum")))
        margins = sums.groupBy("_bins").agg(F.aggregate(ordered, F.lit(self.base), lambda total, x: total + x["sum"]).alias(margin))
        return keyed.join(margins, "_bins").drop("_bins")


def ordered_means(df: DataFrame, category: str, target: str, key: Sequence[str], prior: float) -> DataFrame:
    """Replace a category by the mean target of its earlier rows in an order that only the key's hash sets; the prior counts as one row.

    A row never sees its own target. Running sums go over range slices, so a category may hold most rows.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    rows = df.withColumns({"_category": F.coalesce(F.col(category).cast("string"), F.lit("")), "_turn": F.xxhash64(text), "_one": F.lit(1)})
    summed = running_totals(rows, ["_category"], ["_turn", *key], [target, "_one"], "_cum_")
    mean = (F.col(f"_cum_{target}") - F.col(target) + prior) / F.col("_cum__one")
    return summed.withColumn(category, F.round(mean, 9)).drop("_category", "_turn", "_one", f"_cum_{target}", "_cum__one")


def category_means(df: DataFrame, category: str, target: str, prior: float) -> dict[str, float]:
    """Mean target of each category over all rows, the prior as one row more."""
    means = df.groupBy(F.coalesce(F.col(category).cast("string"), F.lit("")).alias("c")).agg(
        ((F.sum(target) + prior) / (F.count(F.lit(1)) + 1)).alias("m")
    )
    rows = means.limit(CATEGORIES + 1).collect()
    if len(rows) > CATEGORIES:
        raise ValueError(f"{category} has more than {CATEGORIES} values; encode it before")
    return {r["c"]: r["m"] for r in rows}


@dataclass
class Prepared:
    """Rows cut into written blocks, and what a model needs to cut others alike."""

    names: tuple[str, ...]
    blocks: DataFrame
    count: int
    borders: list[list[float]]
    base: float
    loss: str
    category: str | None
    means: dict[str, float]
    prior: float
    bins: int

    def fit(self, settings: Sequence[Setting]) -> list[Boosted]:
        """One ensemble for each setting."""
        grown = fit_blocks(self.blocks, self.count, settings, self.bins)
        return [Boosted(self.names, self.borders, trees, self.base, self.loss, self.category, self.means, self.prior) for trees in grown]

    def held_out_f1(self, settings: Sequence[Setting]) -> list[float]:
        """f1 of class 1 of each setting on the fold that it leaves out; 0 without such rows. No tree reaches the driver to stay."""
        return [2.0 * a / b if b else 0.0 for a, b in held_out_counts(self.blocks, self.count, settings, self.bins)]


def prepare(
    df: DataFrame,
    names: Sequence[str],
    target: str,
    loss: str,
    weight: str | None = None,
    fold: str | None = None,
    category: str | None = None,
    key: Sequence[str] = (),
    bins: int = BINS,
    block_rows: int = BLOCK_ROWS,
) -> Prepared:
    """Bins and blocks that all settings of one loss share. ``key`` orders the rows of a category."""
    rows = df.withColumns(
        {
            "_y": F.col(target).cast("double"),
            "_w": F.col(weight).cast("double") if weight else F.lit(1.0),
            "_fold": F.col(fold).cast("int") if fold else F.lit(-2),
        }
    )
    mean = rows.agg(F.avg("_y")).head()[0]
    base = 0.0 if loss == "logistic" or mean is None else round(mean, 9)
    prior = 0.0 if mean is None else round(mean, 9)
    means: dict[str, float] = {}
    if category:
        means = category_means(rows, category, "_y", prior)
        rows = ordered_means(rows, category, "_y", key, prior)
    borders = quantile_borders(rows, names, bins)
    blocks, count = make_blocks(rows, names, borders, base, block_rows)
    return Prepared(tuple(names), blocks, count, borders, base, loss, category, means, prior, bins)


def fit_boosted(
    df: DataFrame,
    names: Sequence[str],
    target: str,
    settings: Sequence[Setting],
    weight: str | None = None,
    fold: str | None = None,
    category: str | None = None,
    key: Sequence[str] = (),
    bins: int = BINS,
    block_rows: int = BLOCK_ROWS,
) -> list[Boosted]:
    """One ensemble for each setting, all of one loss, from shared bins. ``key`` orders the rows of a category."""
    return prepare(df, names, target, settings[0].loss, weight, fold, category, key, bins, block_rows).fit(settings)


def margins(df: DataFrame, fits: Sequence[Boosted]) -> DataFrame:
    """``df`` with ``_margins``, one for each of the ensembles, which share inputs and borders and have no category."""
    names, borders = fits[0].names, fits[0].borders
    shared = df.sparkSession.sparkContext.broadcast(list(fits))

    def walk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for part in parts:
            bins = _bins([part[c].to_numpy() for c in part], borders)
            yield pd.Series(list(np.column_stack([f.margin(bins) for f in shared.value])))

    inputs = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(c) for c in names]
    return df.withColumn("_margins", F.pandas_udf(walk, "array<double>")(F.struct(*inputs)))
