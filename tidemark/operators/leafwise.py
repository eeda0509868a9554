"""Boosted trees grown leaf by leaf from gradient histograms, with L1/L2 terms and missing values.

Rows stay in a table of binned features, which the executors keep. One job per level: every task sums gradients by (node,
feature, bin), the sums meet by (node, feature), the larger child's are the parent's less the
smaller child's, and each task reports its best split per node. The driver sees these few rows
only and decides which leaf is split next: always the one with the largest gain. Where the sums
of all tasks are few (``GATHERED_BYTES``), they come back instead and the driver finds the splits.
All leaves that may be next are expanded in the same job, so that a tree takes as many jobs as it
has levels.
"""

from __future__ import annotations

import gc
import heapq
import math
import os
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, functions as F

from tidemark import schema as S
from tidemark.functions import scalars as X, sqltext as sql
from tidemark.operators.boosting import (
    PIECES, STAGES_PER_JOB, Ensemble, positive_class_weight, range_points, ranked, ranked_pieces, small_tree, staged_auroc, stop_round,
)
from tidemark.operators.splitting import stratified_sample
from tidemark.session import shared_dir, written

# Rounds after which the rows' scores are written anew.
ROUNDS_PER_TABLE = 10
# Histograms that meet in one task, each a row from every task over the rows.
GROUPS_PER_TASK = 64
# Most bytes of sums that come back from all tasks for one level; above, they meet in tasks of their own.
GATHERED_BYTES = 16 << 20
# Tasks for a core over blocks that many jobs read, and parts of a written table that a task takes.
TASKS_PER_CORE, PARTS_PER_TASK = 4, 4
# Bin of missing values.
MISSING = 0


@dataclass(frozen=True)
class LeafParams:
    leaves: int = 31
    max_depth: int = 6
    step_size: float = 0.1
    min_rows_per_leaf: int = 20
    feature_share: float = 0.8
    row_share: float = 0.8
    l1: float = 0.0
    l2: float = 0.0
    max_bins: int = 64
    seed: int = 42


# ------------------------------------------------------------------------------- binning


def fit_cuts(df: DataFrame, features: Sequence[str], max_bins: int = 64) -> list[np.ndarray]:
    """Ascending cuts of every feature: quantiles of its present values, in one pass for all.

    At most ``max_bins - 2``, as there is one bin more than cuts and one for missing values.
    """
    shares = ", ".join(repr((i + 1) / (max_bins - 1)) + "D" for i in range(max_bins - 2))
    texts = [
        f"percentile_approx(CASE WHEN NOT isnan(CAST({sql.name(c)} AS DOUBLE)) THEN CAST({sql.name(c)} AS DOUBLE) END, array({shares}), 10000) AS q{i}"
        for i, c in enumerate(features)
    ]
    row = df.select(*[F.expr(t) for t in texts]).first()
    return [np.unique(np.array(q or [], dtype=float)) for q in row]


def binned(df: DataFrame, features: Sequence[str], cuts: Sequence[np.ndarray], label: str, key: str, weight: float) -> DataFrame:
    """``bins, y, w, row``: a byte per feature, label, weight, and a hash of the key for draws."""
    given = [np.asarray(c, dtype=float) for c in cuts]
    if any(len(c) > 254 for c in given):
        raise ValueError("a feature has at most 254 cuts")

    def run(batches):
        for batch in batches:
            flat = batch.column(0).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            values = flat.reshape(batch.num_rows, len(given))
            codes = np.empty(values.shape, np.uint8)
            for i, cut in enumerate(given):
                codes[:, i] = np.where(np.isnan(values[:, i]), MISSING, 1 + np.searchsorted(cut, values[:, i]))
            rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(given)), batch.num_rows, [None, pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([rows.cast(pa.binary()), *batch.columns[1:]], names=["bins", "y", "w", "row"])

    y = F.col(label).cast("double")
    rows = df.select(sql.double_array(features).alias("values"), y.alias("y"), X.positive_weight(F.col(label), weight).cast("double").alias("w"), F.xxhash64(key).alias("row"))
    return rows.mapInArrow(run, "bins binary, y double, w double, row bigint")


# Rows of a block to aim for.
BLOCK_ROWS = 65_536
# Binned rows in blocks: each column of some batches as its bytes, so that a level reads few long values.
# The bins of a feature lie together, so that a condition is one comparison of neighbouring bytes.
BLOCKS = "bins binary, y binary, w binary, row binary, margin binary, positive double, negative double"


def dealt(rows: DataFrame) -> DataFrame:
    """Binned rows written as blocks in even parts, at least one per core: every level of every tree reads them."""
    parts = max(rows.rdd.getNumPartitions(), rows.sparkSession.sparkContext.defaultParallelism)

    def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = sum(batch.num_rows for batch in parts)
        bins = np.frombuffer(b"".join(code for batch in parts for code in batch.column(0).to_pylist()), np.uint8)
        y, w, row = (np.concatenate([batch.column(i).to_numpy() for batch in parts]) for i in (1, 2, 3))
        sums = float((w * y).sum()), float((w * (1 - y)).sum())
        parts.clear()
        return _block(bins.reshape(rows, -1).T.tobytes(), y.tobytes(), w.tobytes(), row.tobytes(), b"", *sums)

    def pack(batches):
        parts = []
        for batch in batches:
            if batch.num_rows:
                parts.append(batch)
            if sum(held.num_rows for held in parts) >= BLOCK_ROWS:
                yield packed(parts)
        if parts:
            yield packed(parts)

    return written(rows.repartition(parts, "row").mapInArrow(pack, BLOCKS), "binned")


def _block(*values) -> pa.RecordBatch:
    kinds = [pa.binary()] * 5 + [pa.float64()] * 2
    names = [part.split()[0] for part in BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)


def _opened(raw: Sequence, width: int, base: float) -> tuple[np.ndarray, ...]:
    """``bins`` (features x rows), ``y, w, row`` and ``margin`` of a block; ``base`` before a margin is written."""
    y, w, row = (np.frombuffer(part, kind) for part, kind in zip(raw[1:4], (float, float, np.int64)))
    margin = np.frombuffer(raw[4]) if len(raw[4]) else np.full(len(y), base)
    return np.frombuffer(raw[0], np.uint8).reshape(width, -1), y, w, row, margin


def _unpacked(batches, width: int, base: float):
    """Every block, as a batch of one row, with its :func:`_opened` columns."""
    for batch in batches:
        for block in range(batch.num_rows):
            yield batch.slice(block, 1), _opened([memoryview(column[block].as_buffer()) for column in batch.columns[:5]], width, base)


def _kept(blocks: DataFrame) -> RDD:
    """The columns of written blocks, held by the executors (on their disks where memory ends) for the many jobs that read them.

    Scanning long values and handing them to Python in Arrow batches costs more than the work on them.
    """
    parts = blocks.rdd.getNumPartitions()
    tasks = max(TASKS_PER_CORE * blocks.sparkSession.sparkContext.defaultParallelism, math.ceil(parts / PARTS_PER_TASK))
    columns = blocks.select("bins", "y", "w", "row", "margin")
    return (columns.coalesce(tasks) if tasks < parts else columns).rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)


_SETTLED: list[int] = []


def _settled() -> None:
    """A worker collects garbage after every task; what it has loaded need not be looked through each time."""
    if os.getpid() not in _SETTLED:
        gc.freeze()
        _SETTLED.append(os.getpid())


# ------------------------------------------------------------------------------ one tree


@dataclass
class _Node:
    depth: int
    g: float = 0.0
    h: float = 0.0
    n: float = 0.0
    gain: float = -math.inf
    feature: int = -1
    bin: int = 0
    missing: bool = False
    left_sums: tuple[float, float, float] = (0.0, 0.0, 0.0)
    left: int = -1
    right: int = -1


class _Arrays:
    """A tree over bins as flat arrays; leaves point to themselves."""

    def __init__(self, nodes: Sequence[_Node], values: Sequence[float] | None = None):
        inner = [(i, x) for i, x in enumerate(nodes) if x.left >= 0]
        self.depth = max(x.depth for x in nodes)
        self.values = None if values is None else np.array(values)
        byte = np.uint8
        self.steps = [(i, x.feature, byte(x.bin), byte(x.bin - 1), x.missing, byte(x.left - i)) for i, x in inner] if small_tree(len(nodes), self.depth) else None
        if self.steps is not None:
            return
        own = np.arange(len(nodes))
        split = np.array([x.left >= 0 for x in nodes])
        self.feature = np.array([max(x.feature, 0) for x in nodes])
        bin_, missing = np.array([x.bin for x in nodes]), np.array([x.missing for x in nodes])
        left = np.where(split, [x.left for x in nodes], own)
        right = np.where(split, [x.right for x in nodes], own)
        # The next node for every (node, bin), so that a step is one lookup.
        codes = np.arange(256)
        goes_left = np.where(codes == MISSING, missing[:, None], codes <= bin_[:, None])
        self.next = np.where(goes_left, left[:, None], right[:, None]).astype(np.int32).ravel()

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """Node of every row of ``bins`` (features x rows)."""
        if self.steps is not None:
            return self._swept(bins)
        rows = bins.shape[1]
        at, flat, own = np.zeros(rows, np.int64), np.ascontiguousarray(bins).ravel(), np.arange(rows)
        starts = self.feature * rows
        for _ in range(self.depth):
            code = flat.take(starts.take(at) + own)
            at = self.next.take((at << 8) + code).astype(np.int64)
        return at

    def _swept(self, bins: np.ndarray) -> np.ndarray:
        """Node by node for all rows, parents first: cheaper than look-ups where nodes are few. Children are neighbours."""
        at, one = np.zeros(bins.shape[1], np.uint8), np.uint8(1)
        for i, feature, bin_, less, missing, left in self.steps:
            column = bins[feature]
            # Missing values have the lowest code; one less, it is the highest.
            right = column > bin_ if missing else column - one > less
            step = right.view(np.uint8) + left  # views, as mixed types are many times slower
            if i:
                step *= (at == i).view(np.uint8)
            at += step
        return at


def _soft(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def leaf_value(g: float, h: float, params: LeafParams) -> float:
    return float(-params.step_size * _soft(np.float64(g), params.l1) / (h + params.l2)) if h + params.l2 > 0 else 0.0


def best_splits(sums: np.ndarray, params: LeafParams) -> list[tuple]:
    """Per histogram of ``sums`` (histograms, 3, bins): the best ``(gain, bin, missing left, left g, h, n)``.

    Missing values go to the side where they gain more. Equal gains: lower bin first, missing
    to the right first. The gain is -inf where no split leaves enough rows on both sides.
    """
    whole = sums.sum(axis=2)
    running = np.cumsum(sums[:, :, 1:-1], axis=2)
    sides = np.stack([running, running + sums[:, :, :1]], axis=3)  # histograms, 3, cuts, side of missing

    def score(g, h):
        return np.where(h + params.l2 > 0, _soft(g, params.l1) ** 2 / np.maximum(h + params.l2, 1e-300), 0.0)

    g, h, n = sides[:, 0], sides[:, 1], sides[:, 2]
    rest = whole[:, :, None, None] - sides
    gain = score(g, h) + score(rest[:, 0], rest[:, 1]) - score(whole[:, 0], whole[:, 1])[:, None, None]
    allowed = (n >= params.min_rows_per_leaf) & (rest[:, 2] >= params.min_rows_per_leaf)
    gain = np.where(allowed, gain, -np.inf).reshape(len(sums), -1)
    at = gain.argmax(axis=1) if gain.shape[1] else np.zeros(len(sums), np.int64)
    found = []
    for i, k in enumerate(at):
        cut, side = divmod(int(k), 2)
        value = float(gain[i, k]) if gain.shape[1] else -math.inf
        left = tuple(float(v) for v in sides[i, :, cut, side]) if gain.shape[1] else (0.0, 0.0, 0.0)
        found.append((value, cut + 1, bool(side), *left))
    return found


_SUMS = "kind int, node int, feature int, sums binary, best array<double>"
_HISTOGRAM, _BEST = 0, 1


class Booster:
    """A fit in progress: trees so far, and the rows with their scores as a written table.

    ``advance`` adds rounds at any time later; it goes on from the written scores.
    """

    def __init__(self, rows: DataFrame, features: Sequence[str], cuts: Sequence[np.ndarray], params: LeafParams, kept: RDD | None = None):
        self.features, self.cuts, self.params = list(features), [np.asarray(c, dtype=float) for c in cuts], params
        self.width = max((len(c) for c in self.cuts), default=0) + 2
        positive, negative = rows.agg(F.sum("positive"), F.sum("negative")).first()
        self.base = math.log(positive / negative) if positive and negative else 0.0
        self.rows = rows
        self.kept = _kept(rows) if kept is None else kept
        self.given = kept
        self.tasks = self.kept.getNumPartitions()
        self.recent: list[_Arrays] = []
        self.fresh: list[_Arrays] = []
        self.frames: list[pd.DataFrame] = []
        self.few = self._few_sums(self._wanted())

    @property
    def rounds(self) -> int:
        return len(self.frames)

    def advance(self, rounds: int) -> "Booster":
        for _ in range(rounds):
            self._add_tree()
            if len(self.recent) >= ROUNDS_PER_TABLE:
                self._write()
        return self

    def _write(self) -> None:
        if not self.few:
            self.rows, self.recent = written(self._scored(), "margins"), []
            return
        trees, width, base = self.recent, len(self.features), self.base

        def run(blocks):
            for raw in blocks:
                bins, *_, margin = _opened(raw, width, base)
                yield *raw[:4], _margins(trees, bins, margin).tobytes()

        shared_dir(self.rows.sparkSession)  # names the folder of the checkpoints
        scored = self.kept.mapPartitions(run).persist(StorageLevel.MEMORY_AND_DISK)
        scored.checkpoint()
        scored.count()
        self.release()
        self.kept, self.recent = scored, []

    def release(self) -> None:
        """Free what the executors hold of the rows, unless others read it too; it is read again when needed."""
        if self.kept is not self.given:
            self.kept.unpersist()

    def taken(self) -> list[_Arrays]:
        """The trees since the last call."""
        trees, self.fresh = self.fresh, []
        return trees

    def ensemble(self) -> Ensemble:
        return Ensemble(self.features, pd.concat(self.frames, ignore_index=True), self.rounds)

    def _scored(self) -> DataFrame:
        trees, width, base = self.recent, len(self.features), self.base

        def run(batches):
            for block, (bins, *_, margin) in _unpacked(batches, width, base):
                yield block.set_column(4, "margin", pa.array([_margins(trees, bins, margin).tobytes()], pa.binary()))

        return self.rows.mapInArrow(run, self.rows.schema)

    def _add_tree(self) -> None:
        params, number = self.params, self.rounds
        draw = np.random.default_rng([params.seed, number])
        chosen = np.sort(draw.permutation(len(self.features))[: self._wanted()])
        nodes: list[_Node] = [_Node(0)]
        # Of every histogram: the table of the level that has it, or the sums themselves where they are few.
        levels: dict[int, DataFrame | np.ndarray] = {}
        add_level = self._gathered_level if self.few else self._level
        add_level(nodes, {0: (0, -1)}, levels, chosen)
        while True:
            splits = self._splits(nodes)
            expand = [i for i in splits if nodes[i].left < 0]
            if not expand:
                break
            pairs = {}
            for i in expand:
                x = nodes[i]
                x.left, x.right = len(nodes), len(nodes) + 1
                rest = tuple(a - b for a, b in zip((x.g, x.h, x.n), x.left_sums))
                nodes += [_Node(x.depth + 1, *x.left_sums), _Node(x.depth + 1, *rest)]
                # Leaves at the depth limit need no histogram: their sums are known from the split.
                if x.depth + 1 < params.max_depth:
                    pairs[i] = (x.left, x.right) if x.left_sums[2] <= rest[2] else (x.right, x.left)
            if pairs:
                add_level(nodes, pairs, levels, chosen)
        if add_level == self._level:
            for table in reversed(list(dict.fromkeys(levels.values()))):
                table.unpersist()
        self._keep(nodes, splits)

    def _splits(self, nodes: list[_Node]) -> list[int]:
        """Leaves in the order in which they are split: the largest gain first, while leaves are left."""
        order, open_leaves = [], [(-nodes[0].gain, 0)]
        while open_leaves and len(order) < self.params.leaves - 1:
            gain, i = heapq.heappop(open_leaves)
            if -gain <= 0 or nodes[i].depth >= self.params.max_depth:
                continue
            order.append(i)
            if nodes[i].left >= 0:
                for child in (nodes[i].left, nodes[i].right):
                    heapq.heappush(open_leaves, (-nodes[child].gain, child))
        return order

    def _wanted(self) -> int:
        """Features that a tree may use."""
        return max(1, round(self.params.feature_share * len(self.features)))

    def _few_sums(self, chosen: int) -> bool:
        """Whether the sums of all tasks for the widest level of a tree are small enough to be gathered."""
        widest = min(2 ** max(self.params.max_depth - 2, 0), self.params.leaves)
        return self.tasks * widest * chosen * self.width * 24 <= GATHERED_BYTES

    def _partial(self, nodes: list[_Node], pairs: dict[int, tuple[int, int]], chosen: np.ndarray):
        """A function of a task's opened blocks: sums of the summed children as (g h n, parent, feature, bin)."""
        params, bins_of = self.params, self.width
        trees, tree = self.recent, _Arrays(nodes)
        slot = np.full(len(nodes), -1)
        for place, parent in enumerate(pairs):
            slot[pairs[parent][0]] = place
        salt = np.uint64(np.random.default_rng([params.seed, self.rounds, 1]).integers(1 << 62) | 1)
        limit, parents = params.row_share, len(pairs)

        def sums_of(blocks) -> np.ndarray:
            size = parents * bins_of
            sums = np.zeros((3, len(chosen), size))
            for bins, y, w, row, margin in blocks:
                at = slot.take(tree.nodes_of(bins))
                held = np.flatnonzero(at >= 0)
                if limit < 1:
                    held = held[_unit(row.take(held), salt) < limit]
                bins, y, w, first = bins.take(held, axis=1), y.take(held), w.take(held), at.take(held) * bins_of
                margin = _margins(trees, bins, margin.take(held))
                p = 1 / (1 + np.exp(-margin))
                wp = w * p
                g, h = wp - w * y, wp * (1 - p)
                for k, feature in enumerate(chosen):
                    index = first + bins[feature]
                    for i, part in enumerate((g, h, None)):
                        sums[i, k] += np.bincount(index, part, size)
            return sums.reshape(3, len(chosen), parents, bins_of).swapaxes(1, 2)

        return sums_of

    def _gathered_level(self, nodes: list[_Node], pairs: dict[int, tuple[int, int]], levels: dict[int, np.ndarray], chosen: np.ndarray) -> None:
        """As :meth:`_level`, for few sums: a row per task comes back, at most ``GATHERED_BYTES`` in all."""
        sums_of, width, base = self._partial(nodes, pairs, chosen), len(self.features), self.base

        def run(blocks):
            _settled()
            yield sums_of(_opened(raw, width, base) for raw in blocks).tobytes()

        shape = (3, len(pairs), len(chosen), self.width)
        total = np.zeros(shape)
        for raw in self.kept.mapPartitions(run).collect():
            total += np.frombuffer(raw).reshape(shape)
        held = {}
        for place, (parent, (summed, other)) in enumerate(pairs.items()):
            held[summed] = total[:, place].swapaxes(0, 1)
            if other >= 0:
                held[other] = levels[parent] - held[summed]
        levels.update(held)
        for node, sums in held.items():
            splits = best_splits(sums, self.params)
            k = min(range(len(chosen)), key=lambda i: (-splits[i][0], i))
            x, (x.gain, x.bin, x.missing, *left) = nodes[node], splits[k]
            x.feature, x.left_sums = int(chosen[k]), tuple(left)
            x.g, x.h, x.n = map(float, sums[k].sum(axis=1))

    def _level(self, nodes: list[_Node], pairs: dict[int, tuple[int, int]], levels: dict[int, DataFrame], chosen: np.ndarray) -> None:
        """Histograms of the children in ``pairs`` (parent: summed child, other), put into ``levels``, their best splits into ``nodes``."""
        params, bins_of, order = self.params, self.width, list(pairs)
        sums_of, width, base = self._partial(nodes, pairs, chosen), len(self.features), self.base

        def partial(batches):
            parts = sums_of(opened for _, opened in _unpacked(batches, width, base))
            ids = [(parent, feature) for parent in order for feature in chosen.tolist()]
            packed = [np.ascontiguousarray(parts[:, i, j]).tobytes() for i in range(len(order)) for j in range(len(chosen))]
            yield _sum_rows([(_HISTOGRAM, n, f, s, None) for (n, f), s in zip(ids, packed)])

        def meet(batches):
            child: dict[tuple[int, int], np.ndarray] = {}
            above: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for kind, node, feature, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    held, key, part = above if kind else child, (node, feature), np.frombuffer(raw).reshape(3, bins_of)
                    held[key] = held[key] + part if key in held else part
            rows, histograms = [], []
            for (node, feature), part in child.items():
                summed, other = pairs[node]
                rows.append((summed, feature, part))
                if other >= 0:
                    rows.append((other, feature, above[node, feature] - part))
            if not rows:
                return
            best: dict[int, tuple] = {}
            for (node, feature, part), split in zip(rows, best_splits(np.stack([r[2] for r in rows]), params)):
                rank = (-split[0], feature, split[1], split[2])
                if node not in best or rank < best[node][0]:
                    best[node] = rank, (float(feature), *map(float, split), *part.sum(axis=1).tolist())
            histograms = [(_HISTOGRAM, n, f, np.ascontiguousarray(p).tobytes(), None) for n, f, p in rows]
            yield _sum_rows(histograms + [(_BEST, n, -1, None, list(b)) for n, (_, b) in best.items()])

        found = self.rows.mapInArrow(partial, _SUMS)
        above: dict[DataFrame, list[int]] = {}
        for parent in order:
            if parent in levels:
                above.setdefault(levels[parent], []).append(parent)
        for table, held in above.items():
            known = table.where((F.col("kind") == _HISTOGRAM) & F.col("node").isin(held))
            found = found.unionByName(known.withColumn("kind", F.lit(1)))
        tasks = math.ceil(len(order) * len(chosen) / GROUPS_PER_TASK)
        level = found.repartition(tasks, "node", "feature").mapInArrow(meet, _SUMS).persist(StorageLevel.MEMORY_AND_DISK)
        levels.update({child: level for pair in pairs.values() for child in pair if child >= 0})
        # A row per node and task.
        reports: dict[int, tuple] = {}
        for node, b in level.where(F.col("kind") == _BEST).select("node", "best").collect():
            rank = (-b[1], b[0], b[2], b[3])
            if node not in reports or rank < reports[node][0]:
                reports[node] = rank, b
        for node, (_, b) in reports.items():
            x = nodes[node]
            x.feature, x.gain, x.bin, x.missing, x.left_sums = int(b[0]), b[1], int(b[2]), bool(b[3]), tuple(b[4:7])
            x.g, x.h, x.n = b[7:10]

    def _keep(self, nodes: list[_Node], splits: list[int]) -> None:
        """Number the nodes of the final tree anew and take it up."""
        inner = set(splits)
        order = [0]
        for i in order:
            if i in inner:
                order += [nodes[i].left, nodes[i].right]
        place = {i: k for k, i in enumerate(order)}
        first = self.base if not self.frames else 0.0
        rows, final, values = [], [], []
        for i in order:
            x, split = nodes[i], i in inner
            value = 0.0 if split else leaf_value(x.g, x.h, self.params)
            left, right = (place[x.left], place[x.right]) if split else (-1, -1)
            cut = float(self.cuts[x.feature][x.bin - 1]) if split else 0.0
            rows.append((self.rounds, place[i], x.feature if split else -1, cut, left, right, 0.0 if split else value + first, x.n, x.gain if split else 0.0, int(split and x.missing)))
            final.append(_Node(x.depth, feature=x.feature if split else -1, bin=x.bin, missing=x.missing, left=left, right=right))
            values.append(value)
        names = "tree node feature threshold left right value cover gain missing".split()
        self.frames.append(pd.DataFrame(rows, columns=names))
        self.recent.append(_Arrays(final, values))
        self.fresh.append(self.recent[-1])


def _unit(rows: np.ndarray, salt: np.uint64) -> np.ndarray:
    """A number in [0, 1) per row and salt."""
    x = rows.view(np.uint64) * salt
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(32))) >> np.uint64(11)).astype(float) / float(1 << 53)


def _sum_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.float64())]
    names = ["kind", "node", "feature", "sums", "best"]
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


# ------------------------------------------------------------------------ validation rows

# Rows of a task whose scores of a round are sorted together.
SORTED_ROWS = 65_536


class Held:
    """Validation rows as blocks of bins with their running score: exact AUROC after every round.

    A value is at most a cut exactly where its bin is at most the cut's, so that the scores are those
    of the trees over the values. Rows without a label are left out.
    """

    def __init__(self, validation: DataFrame, booster: Booster, label: str = S.LABEL, key: str = S.KEY):
        self.width, self.base = len(booster.features), booster.base
        known = validation.withColumn(label, F.col(label).cast("int")).where(F.col(label).isNotNull())
        self.blocks = dealt(binned(known, booster.features, booster.cuts, label, key, 1.0))
        self.n_rows = self.blocks.agg(F.sum(F.octet_length("row"))).first()[0] or 0
        self.n_rows //= 8
        self.unwritten: list[_Arrays] = []
        self.rounds = 0

    def auroc(self, trees: Sequence[_Arrays]) -> list[tuple[int, float | None]]:
        """AUROC after each of the next ``trees``, with the number of its round."""
        found = []
        for start in range(0, len(trees), STAGES_PER_JOB):
            if self.unwritten:
                self.blocks, self.unwritten = written(self._scored(), "held-margins"), []
            some = list(trees[start : start + STAGES_PER_JOB])
            values = ranked(self._pieces(some, self._points(some)))
            found += [(self.rounds + place + 1, value) for place, value in sorted(values.items())]
            self.rounds += len(some)
            self.unwritten = some
        return found

    def _scored(self) -> DataFrame:
        trees, width, base = self.unwritten, self.width, self.base

        def run(batches):
            for block, (bins, *_, margin) in _unpacked(batches, width, base):
                yield block.set_column(4, "margin", pa.array([_margins(trees, bins, margin).tobytes()], pa.binary()))

        return self.blocks.mapInArrow(run, self.blocks.schema)

    def _points(self, trees: list[_Arrays]) -> list[np.ndarray]:
        """Per round the ends of the ranges in which scores meet; any points give the same result."""
        width, base = self.width, self.base

        def run(batches):
            # The rows are dealt by a hash, so the first block of a task tells how its scores lie.
            first = None
            for _, (bins, *_, margin) in _unpacked(batches, width, base):
                if first is None:
                    first = np.quantile(_stages(trees, bins, margin), np.linspace(0, 1, 201)[1:-1], axis=1).T.copy()
            rows = [] if first is None else [first.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["scores"])

        def sketch() -> list[np.ndarray]:
            raw = [np.frombuffer(row[0]).reshape(len(trees), -1) for row in self.blocks.mapInArrow(run, "scores binary").collect()]
            return list(np.concatenate(raw, axis=1))

        return range_points(self.n_rows, len(trees), sketch)

    def _pieces(self, trees: list[_Arrays], points: list[np.ndarray]) -> DataFrame:
        width, base = self.width, self.base

        def run(batches):
            scores, positive = [], []

            def flush():
                batch = ranked_pieces(np.concatenate(scores, axis=1), np.concatenate(positive), points)
                scores.clear()
                positive.clear()
                return batch

            for _, (bins, y, _, _, margin) in _unpacked(batches, width, base):
                scores.append(_stages(trees, bins, margin))
                positive.append(y == 1)
                if sum(map(len, positive)) >= SORTED_ROWS:
                    yield flush()
            if scores:
                yield flush()

        return self.blocks.mapInArrow(run, PIECES)


def _margins(trees: Sequence[_Arrays], bins: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Score of every row after all of the trees, one by one."""
    for tree in trees:
        margin = margin + tree.values.take(tree.nodes_of(bins))
    return margin


def _stages(trees: Sequence[_Arrays], bins: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Score of every row after each of the trees (trees x rows)."""
    scores = np.empty((len(trees), len(margin)))
    for place, tree in enumerate(trees):
        margin = scores[place] = _margins([tree], bins, margin)
    return scores


# --------------------------------------------------------------------------------- fitting


def start(train: DataFrame, features: Sequence[str], params: LeafParams, label: str = S.LABEL, key: str = S.KEY, weight: float | None = None, cuts: Sequence[np.ndarray] | None = None) -> Booster:
    """Bin and write the rows; no tree yet."""
    if weight is None:
        weight = positive_class_weight(train, label).first()["weight"]
    if cuts is None:
        cuts = fit_cuts(train, features, params.max_bins)
    return Booster(dealt(binned(train, features, cuts, label, key, weight)), features, cuts, params)


def fit_leafwise(
    train: DataFrame, validation: DataFrame, features: Sequence[str], params: LeafParams = LeafParams(), label: str = S.LABEL,
    max_rounds: int = 5_000, patience: int = 50, weight: float | None = None,
) -> Ensemble:
    """Trees up to the round with the best validation AUROC, stopped after ``patience`` rounds without gain.

    Rounds are added in blocks of half the patience and then scored together, so that at most
    one block is grown in vain. Rows without a label count as negatives.
    """
    booster = start(train, features, params, label, weight=weight)
    held = Held(validation, booster, label)
    log: list[tuple[int, float]] = []
    while True:
        booster.advance(min(max(1, patience // 2), max_rounds - booster.rounds))
        log += held.auroc(booster.taken())
        best = max(log, key=lambda entry: (entry[1] if entry[1] is not None else -1.0, -entry[0]))[0]
        if booster.rounds >= max_rounds or booster.rounds - best >= patience:
            break
    booster.release()
    chosen = booster.ensemble().first(stop_round(log, patience))
    chosen.log = log
    return chosen


# ---------------------------------------------------------------------------------- search

# Ranges of the search, low to high, and the parameters drawn on a log scale.
SEARCH_SPACE = {
    "leaves": (20, 150),
    "max_depth": (4, 9),
    "step_size": (0.01, 0.3),
    "min_rows_per_leaf": (20, 150),
    "feature_share": (0.5, 1.0),
    "row_share": (0.5, 1.0),
    "l1": (1e-8, 10.0),
    "l2": (1e-8, 10.0),
}
LOG_SCALE = {"step_size", "l1", "l2"}
WHOLE = {"leaves", "max_depth", "min_rows_per_leaf"}
# Share of the trials that stay for the next rung is one in so many.
HALVING = 3


def draw_trials(trials: int, seed: int = 42) -> list[LeafParams]:
    rng = np.random.default_rng(seed)
    drawn = []
    for _ in range(trials):
        found = {}
        for name, (low, high) in SEARCH_SPACE.items():
            if name in WHOLE:
                found[name] = int(rng.integers(low, high + 1))
            elif name in LOG_SCALE:
                found[name] = float(math.exp(rng.uniform(math.log(low), math.log(high))))
            else:
                found[name] = float(rng.uniform(low, high))
        drawn.append(LeafParams(**found, seed=seed))
    return drawn


def rungs(trials: int, max_rounds: int) -> list[int]:
    """Rounds after which trials are compared; the last is ``max_rounds``, where one trial is left or few."""
    steps = [max_rounds]
    while HALVING ** len(steps) < trials and steps[0] > 1:
        steps.insert(0, max(1, steps[0] // HALVING))
    return steps


@dataclass
class _Trial:
    booster: Booster
    log: list[tuple[int, float]] = field(default_factory=list)

    def value(self, patience: int) -> float | None:
        """AUROC of the best round before patience ran out."""
        return dict(self.log)[stop_round(self.log, patience)]


def search_leafwise(
    train: DataFrame, validation: DataFrame, features: Sequence[str], trials: int = 50, label: str = S.LABEL, sample_fraction: float = 0.3,
    max_rounds: int = 300, patience: int = 30, seed: int = 42, timeout: float | None = None, parallel: int = 4,
) -> tuple[DataFrame, LeafParams]:
    """Successive halving by validation AUROC over eight parameters, on an exact stratified sample.

    All trials start with few rounds; of every rung the best third goes on, resumed from its
    written scores, up to ``max_rounds`` or until patience ends. Returns the log ``(trial, rung,
    rounds, value, state, params, sample_rows)``, a row per trial and rung, and the best parameters.
    ``state`` is ``kept``, ``dropped``, ``done`` in the last rung, or ``skipped`` beyond the timeout.
    """
    spark = train.sparkSession
    weight = positive_class_weight(train, label).first()["weight"]
    keep = [S.KEY, label, *features]
    sample = written(stratified_sample(train.select(*keep), label, fraction=sample_fraction, seed=seed), "sample")
    held = written(validation.select(*keep), "held")
    n_rows = sample.count()
    cuts = fit_cuts(sample, features)
    rows = dealt(binned(sample, features, cuts, label, S.KEY, weight))
    kept = _kept(rows)
    deadline = None if timeout is None else time.monotonic() + timeout
    running = {i: _Trial(Booster(rows, features, cuts, params, kept)) for i, params in enumerate(draw_trials(trials, seed))}
    log, best = [], None

    def go_on(trial: _Trial, rounds: int) -> bool:
        if deadline is not None and time.monotonic() > deadline:
            return False
        spent = trial.log and trial.log[-1][0] - stop_round(trial.log, patience) >= patience
        if not spent:
            trial.booster.advance(rounds - trial.booster.rounds)
            trial.log += staged_auroc(held, trial.booster.ensemble(), label, after=len(trial.log))
            trial.booster.release()
        return True

    steps = rungs(trials, max_rounds)
    for rung, rounds in enumerate(steps):
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            went = dict(zip(running, pool.map(lambda t: go_on(t, rounds), running.values())))
        values = {i: t.value(patience) if went[i] else None for i, t in running.items()}
        order = sorted((i for i in running if values[i] is not None), key=lambda i: (-values[i], i))
        stay = order[: math.ceil(len(order) / HALVING)] if rung < len(steps) - 1 else order
        for i, trial in running.items():
            state = "skipped" if not went[i] else "done" if rung == len(steps) - 1 else "kept" if i in stay else "dropped"
            params = {name: float(getattr(trial.booster.params, name)) for name in SEARCH_SPACE}
            log.append((i, rung, trial.booster.rounds, values[i], state, params, n_rows))
            if values[i] is not None and (best is None or values[i] > best[0]):
                best = values[i], trial.booster.params
        running = {i: running[i] for i in stay}
    kept.unpersist()
    if best is None:
        raise RuntimeError("no search trial finished")
    kind = "trial int, rung int, rounds int, value double, state string, params map<string,double>, sample_rows bigint"
    return spark.createDataFrame(log, kind), best[1]
