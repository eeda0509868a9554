"""Class-weighted boosted trees on MLlib, stopped on validation AUROC, and their search.

MLlib grows the trees; what is added here is stopping on AUROC with patience, which
needs the score after every round, and a compact tree table that scores and explains
rows in Arrow batches.
"""

from __future__ import annotations

import math
import posixpath
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark import schema as S
from tidemark.functions import scalars as X, sqltext as sql
from tidemark.operators.splitting import stratified_sample
from tidemark.session import fresh_path, shared_dir, written

TREE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, value double, cover double, gain double"
)


# Rounds whose validation scores are ranked together.
STAGES_PER_JOB = 25
# Rows of a round whose scores meet in one group.
RANKED_ROWS = 250_000


# ------------------------------------------------------------------------ class balance


def class_counts(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    return df.agg(
        F.count_if(F.col(label) == 1).alias("n_positive"), F.count_if(F.col(label) == 0).alias("n_negative")
    )


def positive_class_weight(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """``weight`` = negatives per positive, which balances the classes."""
    return class_counts(df, label).select(
        "n_positive", "n_negative", X.ratio(F.col("n_negative"), F.col("n_positive")).alias("weight")
    )


def with_row_weights(df: DataFrame, weight: float, label: str = S.LABEL) -> DataFrame:
    return df.withColumn("weight", X.positive_weight(F.col(label), weight))


# --------------------------------------------------------------------------- tree table


@dataclass
class Ensemble:
    """Trees as rows; ``value`` of a leaf is its term of the log-odds.

    The number of rows is at most ``rounds x 2 ** (depth + 1)``, set by the
    parameters, so the table is small enough to travel with every task.
    """

    features: list[str]
    nodes: pd.DataFrame
    rounds: int
    log: list[tuple[int, float]] = field(default_factory=list)

    def __post_init__(self):
        # 1 where missing values go to the left; trees that never met any send them to the right.
        if "missing" not in self.nodes:
            self.nodes = self.nodes.assign(missing=0)

    def first(self, rounds: int) -> "Ensemble":
        nodes = self.nodes[self.nodes["tree"] < rounds].reset_index(drop=True)
        return Ensemble(self.features, nodes, rounds, self.log)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, TREE_SCHEMA + ", missing int").coalesce(1).write.mode("overwrite").parquet(posixpath.join(path, "trees"))
        names = [(i, name) for i, name in enumerate(self.features)]
        spark.createDataFrame(names, "place int, feature string").coalesce(1).write.mode("overwrite").parquet(
            posixpath.join(path, "features")
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Ensemble":
        nodes = spark.read.parquet(posixpath.join(path, "trees")).orderBy("tree", "node").toPandas()
        names = spark.read.parquet(posixpath.join(path, "features")).orderBy("place").toPandas()["feature"]
        return cls(list(names), nodes, int(nodes["tree"].max()) + 1)


def ensemble_of(model: GBTClassificationModel, features: Sequence[str]) -> Ensemble:
    """Read the trees of a fitted MLlib model from its own saved form."""
    spark = SparkSession.active()
    path = fresh_path(spark, "gbt")
    model.save(path)
    node = "nodeData."
    rows = spark.read.parquet(posixpath.join(path, "data")).select(
        F.col("treeID").alias("tree"), F.col(node + "id").alias("node"),
        F.when(F.col(node + "leftChild") >= 0, F.col(node + "split.featureIndex")).otherwise(-1).alias("feature"),
        F.when(F.col(node + "leftChild") >= 0, F.col(node + "split.leftCategoriesOrThreshold")[0])
        .otherwise(0.0).alias("threshold"),
        F.col(node + "leftChild").alias("left"), F.col(node + "rightChild").alias("right"),
        F.col(node + "prediction").alias("value"), F.col(node + "rawCount").cast("double").alias("cover"),
        F.when(F.col(node + "leftChild") >= 0, F.col(node + "gain") * F.col(node + "impurityStats")[0])
        .otherwise(0.0).alias("gain"),
    )
    nodes = rows.toPandas().sort_values(["tree", "node"]).reset_index(drop=True)
    weights = np.asarray(model.treeWeights)
    # The probability is 1 / (1 + exp(-2F)), so the log-odds are twice the margin F.
    nodes["value"] = 2.0 * nodes["value"] * weights[nodes["tree"]]
    return Ensemble(list(features), nodes, len(weights))


# Nodes of a tree that a byte can number.
SMALL_TREE = 256


def small_tree(nodes: int, depth: int) -> bool:
    """Whether visiting every node for all rows at once costs less than look-ups level by level."""
    return nodes <= min(SMALL_TREE, 16 * depth + 2)


class TreeArrays:
    """The tree table as flat arrays with absolute child positions."""

    def __init__(self, nodes: pd.DataFrame):
        sizes = nodes.groupby("tree").size()
        starts = sizes.cumsum() - sizes
        offset = nodes["tree"].map(starts).to_numpy()
        self.leaf = (nodes["feature"] < 0).to_numpy()
        own = np.arange(len(nodes))
        self.roots = starts.to_numpy()
        self.feature = np.where(self.leaf, 0, nodes["feature"]).astype(np.int64)
        self.threshold = nodes["threshold"].to_numpy(dtype=float)
        # Node ids are preorder positions within a tree, so id + start is a row.
        self.left = np.where(self.leaf, own, nodes["left"] + offset).astype(np.int32)
        self.right = np.where(self.leaf, own, nodes["right"] + offset).astype(np.int32)
        # Right child at 2 x node, left child after it.
        self.children = np.column_stack([self.right, self.left]).astype(np.int64).ravel()
        self.value = nodes["value"].to_numpy(dtype=float)
        self.cover = nodes["cover"].to_numpy(dtype=float)
        self.missing = nodes["missing"].to_numpy(dtype=bool)
        self.small = [self._steps(root, root + size) for root, size in zip(self.roots.tolist(), sizes.tolist())]

    def _steps(self, root: int, end: int) -> tuple[list[tuple], np.ndarray] | None:
        """Conditions of a tree of few nodes, parents first and children neighbours, and the values by that numbering."""
        order, depth = [root], {root: 0}
        for at in order:
            if not self.leaf[at]:
                order += [int(self.left[at]), int(self.right[at])]
                depth |= dict.fromkeys(order[-2:], depth[at] + 1)
        if not small_tree(len(order), max(depth.values())):
            return None
        place = {at: i for i, at in enumerate(order)}
        steps = [
            (i, int(self.feature[at]), float(self.threshold[at]), bool(self.missing[at]), np.uint8(place[int(self.left[at])] - i))
            for i, at in enumerate(order) if not self.leaf[at]
        ]
        return steps, self.value[order]

    def tree_terms(self, values: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
        """Leaf value of every (row, tree), for trees ``first`` to ``last`` (exclusive)."""
        columns = np.ascontiguousarray(values.T)
        flat, own = columns.ravel(), np.arange(len(values))
        some_missing = bool(np.isnan(flat).any())
        roots = self.roots[first:last]
        terms = np.empty((len(roots), len(values)))
        for t, (root, small) in enumerate(zip(roots, self.small[first:last])):
            if small is not None:
                terms[t] = _swept(columns, *small)
                continue
            at = np.full(len(values), root)
            while True:
                feature = self.feature.take(at)
                value = flat.take(feature * len(values) + own)
                goes_left = value <= self.threshold.take(at)
                if some_missing:
                    goes_left |= np.isnan(value) & self.missing.take(at)
                nxt = self.children.take(2 * at + goes_left)
                if (nxt == at).all():
                    break
                at = nxt
            terms[t] = self.value.take(at)
        return terms.T


def _swept(columns: np.ndarray, steps: Sequence[tuple], values: np.ndarray) -> np.ndarray:
    """Leaf values, node by node for all rows at once: cheaper than look-ups where nodes are few."""
    at = np.zeros(columns.shape[1], np.uint8)
    for i, feature, cut, missing, left in steps:
        # No comparison holds for a missing value.
        if missing:
            step = (columns[feature] > cut).view(np.uint8) + left
        else:
            step = left + np.uint8(1) - (columns[feature] <= cut).view(np.uint8)
        if i:
            step *= (at == i).view(np.uint8)
        at += step
    return values.take(at)


def feature_struct(features: Sequence[str]) -> Column:
    parts = ", ".join(f"'f{i}', CAST({sql.name(c)} AS DOUBLE)" for i, c in enumerate(features))
    return F.expr(f"named_struct({parts})")


def matrix_of(batch: pa.StructArray) -> np.ndarray:
    """Rows x fields of a batch of doubles; NULL becomes NaN."""
    return np.column_stack([field.to_numpy(zero_copy_only=False) for field in batch.flatten()])


def lists_of(rows: np.ndarray) -> pa.ListArray:
    """A list of doubles per row."""
    starts = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(np.ascontiguousarray(rows).ravel()))


def log_odds_column(spark: SparkSession, ensemble: Ensemble) -> Column:
    trees = spark.sparkContext.broadcast(TreeArrays(ensemble.nodes))

    # No iterators: functions of the same columns are then evaluated in one pass.
    @F.arrow_udf("double")
    def log_odds(values: pa.Array) -> pa.Array:
        return pa.array(trees.value.tree_terms(matrix_of(values)).sum(axis=1))

    return log_odds(feature_struct(ensemble.features))


def probability(log_odds: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-log_odds))


def predict(df: DataFrame, ensemble: Ensemble, target: str = "probability") -> DataFrame:
    return df.withColumn(target, probability(log_odds_column(df.sparkSession, ensemble)))


# Scores of a round and range: those of the positives and of the others, ascending, with how often each occurs.
PIECES = "round int, bucket int, pos binary, n_pos binary, neg binary, n_neg binary"


def range_points(n_rows: int, rounds: int, sketch: Callable[[], Sequence[np.ndarray]]) -> list[np.ndarray]:
    """Per round the ends of ranges of about ``RANKED_ROWS`` scores, from some scores of every round."""
    buckets = math.ceil(n_rows / RANKED_ROWS)
    if buckets <= 1:
        return [np.empty(0)] * rounds
    shares = np.arange(1, buckets) / buckets
    return [np.unique(np.quantile(scores, shares)) if len(scores) else np.empty(0) for scores in sketch()]


def ranked_pieces(scores: np.ndarray, positive: np.ndarray, points: Sequence[np.ndarray]) -> pa.RecordBatch:
    """``PIECES`` of ``scores`` (rounds x rows): equal scores become one entry."""
    rows = []
    for place, cut in enumerate(points):
        held = []
        for own in (positive, ~positive):
            values, counts = _distinct(scores[place][own])
            edges = np.searchsorted(values, cut, "right")
            held.append((values, counts, [0, *edges, len(values)]))
        for bucket in range(len(cut) + 1):
            parts = [part[ends[bucket] : ends[bucket + 1]] for values, counts, ends in held for part in (values, counts)]
            if len(parts[0]) or len(parts[2]):
                rows.append((place, bucket, *(part.tobytes() for part in parts)))
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    columns = zip(*rows) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=[part.split()[0] for part in PIECES.split(", ")])


def ranked(pieces: DataFrame) -> dict[int, float | None]:
    """Exact AUROC by round, ties counted half; NULL where a class is absent.

    The entries of a round meet by ranges of its scores.
    """
    def meet(key, table):
        pos, n_pos, neg, n_neg = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("pos", float), ("n_pos", np.int64), ("neg", float), ("n_neg", np.int64))
        )
        order = np.argsort(neg)
        neg, below = neg[order], np.r_[0, np.cumsum(n_neg[order])]
        # Others below, and half of those with the same score.
        won = below[np.searchsorted(neg, pos, "left")] + below[np.searchsorted(neg, pos, "right")]
        facts = {"round": key[0].as_py(), "bucket": key[1].as_py(), "pos": float(n_pos.sum()), "neg": float(below[-1]), "won": float((n_pos.astype(float) * won).sum()) / 2}
        return pa.table({name: [value] for name, value in facts.items()}).cast(pa.schema([("round", pa.int32()), ("bucket", pa.int32()), ("pos", pa.float64()), ("neg", pa.float64()), ("won", pa.float64())]))

    sums = pieces.groupBy("round", "bucket").applyInArrow(meet, "round int, bucket int, pos double, neg double, won double")
    # A row per round and range.
    lower = Window.partitionBy("round").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    won = F.col("won") + F.col("pos") * F.coalesce(F.sum("neg").over(lower), F.lit(0.0))
    whole = sums.withColumn("won", won).groupBy("round").agg(F.sum("won").alias("won"), (F.sum("pos") * F.sum("neg")).alias("pairs"))
    return {row["round"]: row["auroc"] for row in whole.select("round", (F.col("won") / F.nullif("pairs", F.lit(0.0))).alias("auroc")).collect()}


def _distinct(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct scores in ascending order, and how often each occurs."""
    ordered = np.sort(scores)
    first = np.flatnonzero(np.r_[len(ordered) > 0, ordered[1:] != ordered[:-1]])
    return ordered[first], np.diff(np.r_[first, len(ordered)])


def _ranked_rounds(block: DataFrame, rounds: int) -> dict[int, float | None]:
    """:func:`ranked` by place in the array ``scores``."""
    def sketch() -> list[np.ndarray]:
        n = math.ceil(block.count() / RANKED_ROWS)
        shares = sql.doubles([i / n for i in range(1, n)])
        found = block.select(*[F.percentile_approx(F.col("scores")[i], shares, 4 * n).alias(f"q{i}") for i in range(rounds)]).first()
        return [np.array(q or [], dtype=float) for q in found]

    points = range_points(block.count(), rounds, sketch)

    def pieces(batches):
        for batch in batches:
            y = batch.column(0).to_numpy() == 1
            yield ranked_pieces(batch.column(1).flatten().to_numpy().reshape(len(y), rounds).T, y, points)

    known = block.select(F.col("y").cast("int").alias("y"), "scores").where("y IS NOT NULL")
    return ranked(known.mapInArrow(pieces, PIECES))


def staged_auroc(df: DataFrame, ensemble: Ensemble, label: str, after: int = 0) -> list[tuple[int, float]]:
    """Exact AUROC after each round beyond ``after``; a row per round comes back.

    Rows carry their running score from block to block of rounds, so that each tree is
    evaluated once per row.
    """
    trees = df.sparkSession.sparkContext.broadcast(TreeArrays(ensemble.nodes))

    def stages(first: int, last: int):
        @F.arrow_udf("array<double>")
        def running(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for values, score in batches:
                terms = trees.value.tree_terms(matrix_of(values), first, last)
                yield lists_of(np.cumsum(np.column_stack([score.to_numpy(), terms]), axis=1)[:, 1:])

        return running(F.col("values"), F.col("score"))

    rows = df.select(feature_struct(ensemble.features).alias("values"), F.col(label).alias("y"), F.lit(0.0).alias("score"))
    if after:
        rows = rows.withColumn("score", F.element_at(stages(0, after), -1))
    found = []
    # A few rounds per job, so that a row is never multiplied by the whole ensemble.
    for start in range(after, ensemble.rounds, STAGES_PER_JOB):
        end = min(start + STAGES_PER_JOB, ensemble.rounds)
        block = written(rows.select("values", "y", stages(start, end).alias("scores")), "stages")
        found += [(place + start + 1, auroc) for place, auroc in _ranked_rounds(block, end - start).items()]
        rows = block.select("values", "y", F.element_at("scores", -1).alias("score"))
    return sorted(found)


# ------------------------------------------------------------------------------ fitting


@dataclass(frozen=True)
class BoostParams:
    """Parameters of the boosted trees, under MLlib's meaning."""

    max_depth: int = 5
    step_size: float = 0.1
    min_rows_per_leaf: int = 20
    row_share: float = 0.8
    feature_share: float = 0.8
    max_bins: int = 64
    seed: int = 42


def _classifier(params: BoostParams, rounds: int, label: str) -> GBTClassifier:
    share = "all" if params.feature_share >= 1 else str(params.feature_share)
    return GBTClassifier(
        featuresCol="_features", labelCol=label, weightCol="_weight", maxIter=rounds,
        maxDepth=params.max_depth, stepSize=params.step_size, minInstancesPerNode=params.min_rows_per_leaf,
        subsamplingRate=params.row_share, featureSubsetStrategy=share, maxBins=params.max_bins,
        seed=params.seed, checkpointInterval=20, cacheNodeIds=True, maxMemoryInMB=512,
    )


def fit_boosted(
    train: DataFrame, validation: DataFrame, features: Sequence[str], params: BoostParams = BoostParams(),
    label: str = S.LABEL, max_rounds: int = 5_000, patience: int = 50, weight: float | None = None,
    first_rounds: int | None = None,
) -> Ensemble:
    """Trees up to the round with the best validation AUROC.

    Rounds are added in doublings: a fit with more rounds repeats the earlier trees
    (same seed), so only new rounds are scored, and the whole costs at most about
    twice the final fit. It stops once ``patience`` rounds brought no gain.
    """
    shared_dir(train.sparkSession)  # gives MLlib its checkpoint folder
    if weight is None:
        weight = positive_class_weight(train, label).first()["weight"]
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features")
    rows = assembler.transform(train).select(
        "_features", F.col(label).cast("double").alias(label), X.positive_weight(F.col(label), weight).alias("_weight")
    )
    rounds = min(max_rounds, first_rounds or 2 * patience)
    log: list[tuple[int, float]] = []
    while True:
        ensemble = ensemble_of(_classifier(params, rounds, label).fit(rows), features)
        log += staged_auroc(validation, ensemble, label, after=len(log))
        best = max(log, key=lambda entry: (entry[1] if entry[1] is not None else -1.0, -entry[0]))[0]
        if rounds >= max_rounds or rounds - best >= patience:
            break
        rounds = min(max_rounds, 2 * rounds)
    chosen = ensemble.first(stop_round(log, patience))
    chosen.log = log
    return chosen


def stop_round(log: Sequence[tuple[int, float]], patience: int) -> int:
    """Best round seen before ``patience`` rounds in a row failed to improve on it."""
    best, best_value = 1, -math.inf
    for number, value in log:
        if number - best > patience:
            break
        if value is not None and value > best_value:
            best, best_value = number, value
    return best


def importance(ensemble: Ensemble, spark: SparkSession, top: int = 30) -> DataFrame:
    """Share of each feature in the total gain of the splits, largest first."""
    gains = ensemble.nodes.groupby("feature")["gain"].sum()
    total = float(ensemble.nodes["gain"].sum()) or 1.0
    rows = [(name, float(gains.get(i, 0.0)) / total) for i, name in enumerate(ensemble.features)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    ).limit(top)


# ------------------------------------------------------------------------------- search

# Ranges of the search, low to high; step size is drawn on a log scale.
SEARCH_SPACE = {
    "max_depth": (4, 9),
    "step_size": (0.01, 0.3),
    "min_rows_per_leaf": (20, 150),
    "feature_share": (0.5, 1.0),
    "row_share": (0.5, 1.0),
}


def draw_trials(trials: int, seed: int = 42) -> list[BoostParams]:
    rng = np.random.default_rng(seed)
    drawn = []
    for _ in range(trials):
        low, high = SEARCH_SPACE["step_size"]
        drawn.append(
            BoostParams(
                max_depth=int(rng.integers(SEARCH_SPACE["max_depth"][0], SEARCH_SPACE["max_depth"][1] + 1)),
                step_size=float(math.exp(rng.uniform(math.log(low), math.log(high)))),
                min_rows_per_leaf=int(
                    rng.integers(SEARCH_SPACE["min_rows_per_leaf"][0], SEARCH_SPACE["min_rows_per_leaf"][1] + 1)
                ),
                feature_share=float(rng.uniform(*SEARCH_SPACE["feature_share"])),
                row_share=float(rng.uniform(*SEARCH_SPACE["row_share"])),
                seed=seed,
            )
        )
    return drawn


def search_params(
    train: DataFrame, validation: DataFrame, features: Sequence[str], trials: int = 50, label: str = S.LABEL,
    sample_fraction: float = 0.3, max_rounds: int = 300, patience: int = 30, seed: int = 42,
    timeout: float | None = None, parallel: int = 4,
) -> tuple[DataFrame, BoostParams]:
    """Random search by validation AUROC on an exact stratified sample of the training rows.

    Trials share one written sample and run side by side; each is itself a set of
    Spark jobs. Returns the trial log ``(trial, params, value, state, sample_rows)``, in which
    trials that the timeout kept from starting are ``skipped``, and the best parameters.
    """
    spark = train.sparkSession
    weight = positive_class_weight(train, label).first()["weight"]
    keep = [S.KEY, label, *features]
    sample = written(stratified_sample(train.select(*keep), label, fraction=sample_fraction, seed=seed), "sample")
    held = written(validation.select(*keep), "held")
    deadline = None if timeout is None else time.monotonic() + timeout
    drawn = draw_trials(trials, seed)

    def run(params: BoostParams) -> float | None:
        if deadline is not None and time.monotonic() > deadline:
            return None
        fitted = fit_boosted(sample, held, features, params, label, max_rounds, patience, weight)
        return dict(fitted.log)[fitted.rounds]

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        values = list(pool.map(run, drawn))
    finished = [(i, p, v) for i, (p, v) in enumerate(zip(drawn, values)) if v is not None]
    n_rows = sample.count()
    if not finished:
        raise RuntimeError("no search trial finished")
    rows = [
        (i, {name: float(getattr(p, name)) for name in SEARCH_SPACE}, v, "skipped" if v is None else "done", n_rows)
        for i, (p, v) in enumerate(zip(drawn, values))
    ]
    log = spark.createDataFrame(rows, "trial int, params map<string,double>, value double, state string, sample_rows bigint")
    return log, max(finished, key=lambda entry: (entry[2], -entry[0]))[1]
