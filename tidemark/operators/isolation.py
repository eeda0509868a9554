"""Isolation forest (Liu, Ting & Zhou 2008): sampled on Spark, built per tree, scored in batches.

Every tree sees a small exact-size sample, so fitting touches the training rows once
to draw the samples and then works on ``trees x sample`` rows. The forest is a node
table whose size depends on those two parameters only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark import schema as S
from tidemark.functions import sqltext as sql
from tidemark.functions.scalars import portable_hash
from tidemark.operators.boosting import feature_struct, matrix_of
from tidemark.operators.encoders import _TableModel
from tidemark.operators.ordering import exact_quantiles
from tidemark.session import written

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, size int, depth int"
)
# Deepest trees that are filled up to whole levels for scoring, and levels that are compared for all rows.
WHOLE_DEPTH, COMPARED_LEVELS = 10, 3
# Rows expected in a bucket of the draw.
BUCKET_ROWS = 8
EULER_GAMMA = 0.5772156649015329


def average_path(n):
    """Expected path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    long = 2.0 * (np.log(safe - 1.0) + EULER_GAMMA) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, long))


# --------------------------------------------------------------------------- sampling


def tickets(spark: SparkSession, trees: int, per_tree: int, buckets: int, seed: int) -> DataFrame:
    """``(tree, bucket)``: the buckets that each tree reads, all of them once ``per_tree`` reaches their number.

    At most ``trees x per_tree`` rows, whatever the size of the table.
    """
    if per_tree >= buckets:
        pairs = spark.range(trees * buckets)
        return pairs.select(F.expr(f"int(id div {buckets})").alias("tree"), F.expr(f"id % {buckets}").alias("bucket"))
    drawn = spark.range(trees * per_tree)
    bucket = F.pmod(portable_hash(F.col("id"), seed + 2_000_003), F.lit(buckets))
    return drawn.select(F.expr(f"int(id div {per_tree})").alias("tree"), bucket.alias("bucket")).distinct()


def tree_samples(df: DataFrame, key: str, columns: Sequence[str], trees: int, sample: int, seed: int, rows: int) -> DataFrame:
    """``(tree, key, values)``, the columns as one array, with exactly ``min(sample, rows)`` distinct rows per tree.

    One hash of its key puts a row into a bucket of about ``BUCKET_ROWS`` rows, and a lookup by
    bucket gives the trees that read it, so a row costs the same for any number of trees. A tree
    reads enough buckets to expect more rows than it needs and keeps those with the smallest
    order, a hash of key and tree; if one got too few, all trees read twice as many buckets.
    Draws depend on keys and parameters only. Rows without a key share one order.
    """
    size = min(sample, rows)
    buckets = max(1, rows // BUCKET_ROWS)
    per_tree = math.ceil((size + 10 * math.sqrt(size) + 20) / BUCKET_ROWS)
    key_col = F.coalesce(F.col(key).cast("long"), F.lit(-1))
    held = df.select(F.col(key).alias("_key"), key_col.alias("_id"), sql.double_array(columns).alias("_values"))
    while True:
        # Rows of the lookup: bounded by the parameters, see tickets.
        readers = F.broadcast(tickets(df.sparkSession, trees, per_tree, buckets, seed))
        drawn = held.withColumn("bucket", F.pmod(portable_hash(F.col("_id"), seed), F.lit(buckets))).join(readers, "bucket")
        drawn = written(drawn.select("tree", "_key", portable_hash(F.col("_id"), F.col("tree") + F.lit(seed + 1_000_003)).alias("_order"), "_values"), "drawn")
        if per_tree >= buckets:
            break
        got = drawn.groupBy("tree").count().agg(F.count(F.lit(1)), F.min("count")).first()
        if got[0] == trees and got[1] >= size:
            break
        per_tree *= 2
    # Little more than sample rows per tree: bounded by the parameters.
    place = F.row_number().over(Window.partitionBy("tree").orderBy("_order", "_key"))
    kept = drawn.withColumn("_place", place).where(F.col("_place") <= size)
    return kept.select("tree", F.col("_key").alias(key), F.col("_values").alias("values"))


def grow_tree(values: np.ndarray, tree: int, seed: int) -> pd.DataFrame:
    """Node rows of one tree: random usable feature, uniform cut, depth-limited."""
    rng = np.random.default_rng([seed, tree])
    limit = math.ceil(math.log2(max(len(values), 2)))
    rows: list[list] = []
    stack = [(np.arange(len(values)), 0, -1, 0)]
    while stack:
        members, depth, parent, side = stack.pop()
        node = len(rows)
        rows.append([tree, node, -1, 0.0, -1, -1, len(members), depth])
        if parent >= 0:
            rows[parent][4 + side] = node
        if depth >= limit or len(members) <= 1:
            continue
        block = values[members]
        low, high = block.min(axis=0), block.max(axis=0)
        usable = np.flatnonzero(high > low)
        if not len(usable):
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(low[feature], high[feature]))
        goes_left = block[:, feature] <= cut
        rows[node][2:4] = [feature, cut]
        stack.append((members[~goes_left], depth + 1, node, 1))
        stack.append((members[goes_left], depth + 1, node, 0))
    names = [part.split()[0] for part in NODE_SCHEMA.split(", ")]
    return pd.DataFrame(rows, columns=names)


def forest_nodes(samples: DataFrame, size: int, seed: int) -> DataFrame:
    """Build every tree in its own group of ``size`` rows."""

    def build(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) != size:
            raise ValueError(f"tree {key[0]} has {len(rows)} rows, not {size}")
        # A fixed row order makes a rebuilt tree the same tree.
        values = np.array(rows["values"].tolist(), dtype=float).reshape(size, -1)
        values = values[np.lexsort(values.T[::-1])]
        return grow_tree(values, int(key[0]), seed)

    return samples.select("tree", "values").groupBy("tree").applyInPandas(build, NODE_SCHEMA)


# ---------------------------------------------------------------------------- scoring


class _Forest:
    """Node table as flat arrays; children hold absolute positions, leaves point to themselves."""

    def __init__(self, nodes: pd.DataFrame, sample: int):
        nodes = nodes.sort_values(["tree", "node"]).reset_index(drop=True)
        sizes = nodes.groupby("tree").size()
        starts = sizes.cumsum() - sizes
        offsets = nodes["tree"].map(starts).to_numpy()
        own = np.arange(len(nodes))
        leaf = (nodes["feature"] < 0).to_numpy()
        self.roots = starts.to_numpy()
        self.feature = np.where(leaf, 0, nodes["feature"]).astype(np.int64)
        self.threshold = nodes["threshold"].to_numpy(dtype=float)
        left, right = (np.where(leaf, own, nodes[side] + offsets) for side in ("left", "right"))
        # Right child at 2 x node, left child after it.
        self.children = np.column_stack([right, left]).astype(np.int64).ravel()
        self.path = nodes["depth"].to_numpy(dtype=float) + average_path(nodes["size"].to_numpy())
        self.depths = nodes.groupby("tree")["depth"].max().to_numpy()
        self.unit = float(average_path(sample)) or 1.0
        self.whole = [self._levels(root, depth) if depth <= WHOLE_DEPTH else None for root, depth in zip(self.roots, self.depths)]

    def _levels(self, root: int, depth: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """Features and cuts of every level of a tree, and the paths below the last; a leaf stands for all below it."""
        at, levels = np.array([root]), []
        for _ in range(depth):
            levels.append((self.feature[at], self.threshold[at]))
            at = np.column_stack([self.children[2 * at + 1], self.children[2 * at]]).ravel()
        return levels, self.path[at]

    def isolation(self, values: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 is anomalous."""
        rows = len(values)
        total, own = np.zeros(rows), np.arange(rows)
        columns = np.ascontiguousarray(values.T)
        flat = columns.ravel()
        for root, depth, whole in zip(self.roots, self.depths, self.whole):
            if whole is not None:
                total += self._paths(columns, flat, own, *whole)
                continue
            at = np.full(rows, root)
            for _ in range(depth):
                goes_left = flat.take(self.feature.take(at) * rows + own) <= self.threshold.take(at)
                at = self.children.take(2 * at + goes_left)
            total += self.path.take(at)
        return np.power(2.0, -total / len(self.roots) / self.unit)

    @staticmethod
    def _paths(columns: np.ndarray, flat: np.ndarray, own: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]], path: np.ndarray) -> np.ndarray:
        """Path of every row through one tree; the place in a level is twice that in the level above, and one more to the right."""
        # In the first levels all nodes are compared for all rows, and the steps of a row picked bit by bit.
        steps: list[np.ndarray] = []
        for feature, cut in levels[:COMPARED_LEVELS]:
            right = [(~(columns[f] <= c)).view(np.uint8) for f, c in zip(feature, cut)]
            for step in reversed(steps):
                right = [a ^ ((a ^ b) & step) for a, b in zip(right[::2], right[1::2])]
            steps += right
        at = np.zeros(len(own), np.uint8)
        for step in steps:
            at += at
            at += step
        at = at.astype(np.int64)
        for feature, cut in levels[COMPARED_LEVELS:]:
            index = (feature * len(own)).take(at)
            index += own
            right = ~(flat.take(index) <= cut.take(at))
            at += at
            at += right.view(np.uint8).astype(np.int64)
        return path.take(at)


def isolation_column(spark: SparkSession, nodes: DataFrame, columns: Sequence[str], sample: int) -> Column:
    """Isolation score of a row as a column; only the feature columns go to Python.

    The broadcast holds at most ``trees x 2 x sample`` nodes, fixed by the parameters.
    """
    forest = spark.sparkContext.broadcast(_Forest(nodes.toPandas(), sample))

    @F.arrow_udf("double")
    def isolation(values: pa.Array) -> pa.Array:
        return pa.array(forest.value.isolation(matrix_of(values)))

    return isolation(feature_struct(columns))


class _ForestParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "feature columns", TypeConverters.toListString)
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    sampleSize = Param(Params._dummy(), "sampleSize", "rows per tree", TypeConverters.toInt)
    contamination = Param(Params._dummy(), "contamination", "share taken as anomalous", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)
    keyCol = Param(Params._dummy(), "keyCol", "row key", TypeConverters.toString)


class AnomalyForest(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """Unsupervised anomaly score; the label is never read."""

    @keyword_only
    def __init__(self, *, inputCols=None, trees=200, sampleSize=256, contamination=0.035, seed=42, keyCol=S.KEY):
        super().__init__()
        self._setDefault(trees=200, sampleSize=256, contamination=0.035, seed=42, keyCol=S.KEY)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "AnomalyForestModel":
        get = self.getOrDefault
        # A score from an earlier run must not become a feature.
        columns = [c for c in get("inputCols") if c != S.SCORE]
        rows = df.count()
        size = min(get("sampleSize"), rows)
        samples = tree_samples(df, get("keyCol"), columns, get("trees"), get("sampleSize"), get("seed"), rows)
        model = AnomalyForestModel()
        model.table = written(forest_nodes(samples, size, get("seed")), "forest")
        raw = df.select((-isolation_column(df.sparkSession, model.table, columns, size)).alias("raw"))
        # The offset centres the score: it is 0 at the contamination quantile.
        raw = written(raw, "isolation")
        offset = exact_quantiles(raw, ["raw"], [get("contamination")]).first()["q0"]
        return model._set(
            state={"columns": columns, "sample": size, "offset": offset, "has_table": True}
        )


class AnomalyForestModel(_TableModel):
    """Adds ``anomaly_score``: higher is more anomalous, 0 is the contamination cut."""

    _column: Column | None = None

    def score_column(self) -> Column:
        if self._column is None:
            isolation = isolation_column(
                self.table.sparkSession, self.table, self.learned("columns"), self.learned("sample")
            )
            self._column = isolation + F.lit(self.learned("offset"))
        return self._column

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(S.SCORE, self.score_column())
