"""Additive explanations of boosted trees and the tables drawn from them.

Path-dependent Tree SHAP (Lundberg, Erion & Lee 2018): a row's terms plus the
ensemble's expected value equal its log-odds.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions import scalars as X, sqltext as sql
from tidemark.operators.boosting import Ensemble, TreeArrays, feature_struct, lists_of, matrix_of


# Conditions of a table of terms; it has an entry for every combination of their outcomes.
TABLE_BITS = 8


class _Leaf:
    """One root-to-leaf path, its repeated features merged into one interval each."""

    __slots__ = ("features", "low", "high", "share", "missing", "value", "sides")

    def __init__(self, path: list[tuple[int, float, float, float, bool, int, bool]], value: float):
        merged: dict[int, list] = {}
        for feature, low, high, share, missing, node, left in path:
            if feature in merged:
                entry = merged[feature]
                entry[:] = max(entry[0], low), min(entry[1], high), entry[2] * share, entry[3] and missing, [*entry[4], (node, left)]
            else:
                merged[feature] = [low, high, share, missing, [(node, left)]]
        self.features = np.array(list(merged), dtype=np.int64)
        self.low, self.high, self.share = (np.array([e[k] for e in merged.values()]) for k in range(3))
        self.missing = np.array([e[3] for e in merged.values()], dtype=bool)
        # Of every feature the nodes on the path, and whether it goes left there.
        self.sides = [e[4] for e in merged.values()]
        self.value = value

    def add_terms(self, columns: np.ndarray, gaps: np.ndarray | None, terms: np.ndarray) -> None:
        """Add the Shapley terms of every row; all arrays are features x rows, ``gaps`` marks missing values.

        A row's terms depend only on which of the path's conditions hold for it, so that they
        are worked out once per combination where those are fewer than the rows.
        """
        holds = []
        for feature, low, high, missing in zip(self.features, self.low, self.high, self.missing):
            held = (columns[feature] > low) & (columns[feature] <= high)
            holds.append(held | gaps[feature] if missing and gaps is not None else held)
        m, rows = len(self.features), columns.shape[1]
        if m > 16 or 1 << m > rows:
            of_path = self.terms(np.column_stack(holds).astype(float)).T
        else:
            table = self.table()
            which = np.zeros(rows, np.uint16)
            for bit, held in enumerate(holds):
                which |= held.astype(np.uint16) << np.uint16(bit)
            which = which.astype(np.int64)
            of_path = (part.take(which) for part in table)
        for feature, part in zip(self.features, of_path):
            terms[feature] += part

    def table(self) -> np.ndarray:
        """Terms (features x combinations) by which conditions hold, the first feature in the lowest bit."""
        m = len(self.features)
        return self.terms((np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(float)).T.copy()

    def terms(self, holds: np.ndarray) -> np.ndarray:
        """Shapley terms of rows x features of the path, from where its conditions hold (1 or 0).

        The weight of k present features among m is the integral of
        ``x ** k * (1 - x) ** (m - 1 - k)``, so a term is the integral of a product of
        linear factors, one per other feature. Gauss-Legendre nodes, half as many as
        features, integrate that polynomial exactly: the work grows with m squared and
        nothing is tabulated.
        """
        nodes, weights = _legendre((len(self.features) + 1) // 2)
        total = np.zeros_like(holds)
        for x, w in zip(nodes, weights):
            factors = self.share * (1 - x) + holds * x  # positive, as shares and x are inside (0, 1)
            total += w * factors.prod(axis=1, keepdims=True) / factors
        return self.value * (holds - self.share) * total


@functools.cache
def _legendre(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and weights on (0, 1)."""
    x, w = np.polynomial.legendre.leggauss(n)
    return (x + 1) / 2, w / 2


class _Table:
    """Terms of all leaves below a node, by the outcomes of the conditions above and below it."""

    def __init__(self, arrays: TreeArrays, nodes: list[int], leaves: list[_Leaf]):
        self.conditions = [(int(arrays.feature[at]), float(arrays.threshold[at]), bool(arrays.missing[at])) for at in nodes]
        bit = {at: i for i, at in enumerate(nodes)}
        outcomes = np.arange(1 << len(nodes))
        self.terms: dict[int, np.ndarray] = {}
        for leaf in leaves:
            which = np.zeros(len(outcomes), np.int64)
            for k, sides in enumerate(leaf.sides):
                holds = np.logical_and.reduce([(outcomes >> bit[at] & 1) == left for at, left in sides])
                which |= holds.astype(np.int64) << k
            for feature, part in zip(leaf.features.tolist(), leaf.table()):
                self.terms[feature] = self.terms.get(feature, 0.0) + part.take(which)

    def add_terms(self, columns: np.ndarray, gaps: np.ndarray | None, terms: np.ndarray) -> None:
        """As :meth:`_Leaf.add_terms`, for all its leaves."""
        which = np.zeros(columns.shape[1], np.uint8)
        for i, (feature, cut, missing) in enumerate(self.conditions):
            left = columns[feature] <= cut
            if missing and gaps is not None:
                left |= gaps[feature]
            which |= left.view(np.uint8) << np.uint8(i)
        which = which.astype(np.int64)
        for feature, part in self.terms.items():
            terms[feature] += part.take(which)


class Explainer:
    """Leaves of an ensemble, ready to explain batches of rows."""

    def __init__(self, ensemble: Ensemble):
        arrays = self.arrays = TreeArrays(ensemble.nodes)
        self.width = len(ensemble.features)
        self.leaves: list[_Leaf] = []
        self.tables: list[_Table | _Leaf] | None = None
        self.expected = 0.0
        # Conditions and leaves of every table.
        self.parts: list[tuple[list[int], list[_Leaf]]] = []
        for root in arrays.roots:
            self._add_part(int(root), [], *self._below(int(root), []), arrays.cover[root])

    def _below(self, node: int, path: list) -> tuple[list[int], list[tuple[list, int]]]:
        """Inner nodes below a node, itself included, and its leaves with their paths."""
        arrays, inner, leaves = self.arrays, [], []
        stack: list[tuple[int, list]] = [(node, path)]
        while stack:
            at, path = stack.pop()
            if arrays.leaf[at]:
                leaves.append((path, at))
                continue
            inner.append(at)
            feature, cut = int(arrays.feature[at]), float(arrays.threshold[at])
            left, right = int(arrays.left[at]), int(arrays.right[at])
            missing = bool(arrays.missing[at])
            stack.append((left, path + [(feature, -math.inf, cut, arrays.cover[left] / arrays.cover[at], missing, at, True)]))
            stack.append((right, path + [(feature, cut, math.inf, arrays.cover[right] / arrays.cover[at], not missing, at, False)]))
        return inner, leaves

    def _add_part(self, node: int, path: list, inner: list[int], leaves: list[tuple[list, int]], rows: float) -> None:
        """Tables for the leaves below a node: one where the conditions are few, else those of its children."""
        arrays = self.arrays
        if inner and len(path) + len(inner) > TABLE_BITS:
            for child in (int(arrays.left[node]), int(arrays.right[node])):
                way = next(p for p, _ in leaves if len(p) > len(path) and p[len(path)][5:] == (node, child == arrays.left[node]))[: len(path) + 1]
                self._add_part(child, way, *self._below(child, way), rows)
            return
        held = []
        for way, at in leaves:
            self.expected += arrays.value[at] * arrays.cover[at] / rows
            if way:
                held.append(_Leaf(way, float(arrays.value[at])))
        self.leaves += held
        if held:
            self.parts.append(([step[5] for step in path] + inner, held))

    def explain(self, values: np.ndarray) -> np.ndarray:
        columns = np.ascontiguousarray(values.T)
        gaps = np.isnan(columns)
        terms = np.zeros(columns.shape)
        for part in self.leaves if len(values) < 1 << TABLE_BITS else self._tables():
            part.add_terms(columns, gaps if gaps.any() else None, terms)
        return terms.T

    def _tables(self) -> list[_Table | _Leaf]:
        """Worked out once, where batches are larger than the tables; leaves below long paths stay as they are."""
        if self.tables is None:
            self.tables = []
            for nodes, leaves in self.parts:
                self.tables += [_Table(self.arrays, nodes, leaves)] if len(nodes) <= TABLE_BITS else leaves
        return self.tables


def contributions_column(spark: SparkSession, ensemble: Ensemble) -> tuple[Column, float]:
    """``array<double>`` of terms in feature order, and the expected log-odds."""
    explainer = Explainer(ensemble)
    shared = spark.sparkContext.broadcast(explainer)

    @F.arrow_udf("array<double>")
    def contributions(values: pa.Array) -> pa.Array:
        return lists_of(shared.value.explain(matrix_of(values)))

    return contributions(feature_struct(ensemble.features)), explainer.expected


# ---------------------------------------------------------------- tables of contributions


def contribution_rows(df: DataFrame, key: str, features: Sequence[str], terms: str, values: str | None = None) -> DataFrame:
    """Long form ``(key, feature, contribution, value)`` of an array column of terms."""
    names = sql.texts(features)
    held = F.col(values) if values else sql.double_array(features)
    zipped = F.arrays_zip(names.alias("feature"), F.col(terms).alias("contribution"), held.alias("value"))
    return df.select(key, F.explode(zipped).alias("z")).select(
        key, F.col("z.feature"), F.col("z.contribution"), F.col("z.value")
    )


def mean_abs_contributions(df: DataFrame, features: Sequence[str], terms: str, top: int | None = 20) -> DataFrame:
    """Mean absolute term per feature, largest first; one aggregate, nothing is exploded."""
    wide = df.agg(*[F.expr(f"avg(abs({sql.name(terms)}[{i}])) AS m{i}") for i in range(len(features))])
    entries = [f"named_struct('feature', {sql.text(f)}, 'mean_abs', m{i})" for i, f in enumerate(features)]
    rows = wide.select(sql.rows_of(entries).alias("e")).select("e.*")
    ordered = rows.orderBy(F.col("mean_abs").desc(), "feature")
    return ordered if top is None else ordered.limit(top)


def largest_places(terms: pa.ListArray, top: int) -> pa.ListArray:
    """Places of the ``top`` largest terms of every row by size, ties in order; NULL before all numbers, NaN after."""
    lengths = np.diff(terms.offsets.to_numpy())
    width = int(lengths[0]) if len(lengths) else 0
    flat = terms.flatten()
    if not width or terms.null_count or flat.null_count or (lengths != width).any():
        rows = [None if row is None else sorted(range(len(row)), key=lambda i: _size_order(row[i]))[:top] for row in terms.to_pylist()]
        return pa.array(rows, pa.list_(pa.int32()))
    sizes = np.abs(flat.to_numpy()).reshape(-1, width)
    sizes[np.isnan(sizes)] = -1.0
    own, places = np.arange(len(sizes)), np.empty((len(sizes), min(top, width)), np.int32)
    for k in range(places.shape[1]):
        places[:, k] = sizes.argmax(axis=1)
        sizes[own, places[:, k]] = -2.0
    starts = np.arange(0, places.size + 1, places.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(places.ravel()))


def _size_order(term: float | None) -> tuple[int, float]:
    return (0, 0.0) if term is None else (2, 0.0) if math.isnan(term) else (1, -abs(term))


def strongest(terms: Column, values: Column, features: Sequence[str], top: int) -> Column:
    """The ``top`` largest terms of a row by size, ties in feature order.

    Only their places are looked for in all terms; structs are made of what is kept.
    """
    names = sql.texts(features)

    @F.arrow_udf("array<int>")
    def places(held: pa.Array) -> pa.Array:
        return largest_places(held, top)

    return F.transform(places(terms), lambda i: F.struct(i.alias("place"), terms[i].alias("c"), values[i].alias("v"), names[i].alias("f")))


def factor_column(terms: Column, values: Column, features: Sequence[str], top: int = 3) -> Column:
    """Risk factors of a row: name, rounded term, rounded value or NULL, direction."""
    return F.transform(
        strongest(terms, values, features, top),
        lambda e: F.struct(
            e["f"].alias("feature"),
            F.round(e["c"], 6).alias("shap_value"),
            F.round(X.nan_to_null(e["v"]), 6).alias("feature_value"),
            X.direction(e["c"]).alias("direction"),
        ),
    )


def top_factors(df: DataFrame, key: str, terms: str, values: str, features: Sequence[str], top: int = 3) -> DataFrame:
    """One row per (record, rank) of its strongest factors."""
    factors = factor_column(F.col(terms), F.col(values), features, top)
    return df.select(key, F.posexplode(factors).alias("place", "factor")).select(
        key, (F.col("place") + 1).alias("rank"), "factor.*"
    )


def waterfall_rows(df: DataFrame, key: str, probability: str, factors: str, base: float = X.BASE_LOGIT) -> DataFrame:
    """Steps from the base log-odds to a row's own: its factors, the rest, the total.

    ``(key, step, name, value, measure)``; ``factors`` is an array of structs with
    ``feature`` and ``shap_value``.
    """
    logit = X.logit(F.col(probability), base)
    named = F.aggregate(factors, F.lit(0.0), lambda total, f: total + f["shap_value"])
    rest = logit - F.lit(base) - named

    def step(name: Column, value: Column, measure: str) -> Column:
        return F.struct(name.alias("name"), value.alias("value"), F.lit(measure).alias("measure"))

    steps = F.concat(
        F.array(step(F.lit("Base"), F.lit(base), "absolute")),
        F.transform(factors, lambda f: step(f["feature"], f["shap_value"], "relative")),
        F.array(step(F.lit("Other features"), rest, "relative"), step(F.lit("Prediction"), logit, "total")),
    )
    return df.select(key, F.posexplode(steps).alias("step", "s")).select(key, "step", "s.*")


def case_terms(
    cases: DataFrame, key: str, features: Sequence[str], terms: str, values: str, shown: int = 15
) -> DataFrame:
    """The largest terms of each case, the remainder summed as ``other``."""
    listed = strongest(F.col(terms), F.col(values), features, shown - 1 if len(features) > shown else shown)
    total = F.aggregate(terms, F.lit(0.0), lambda acc, c: acc + c)
    named = F.aggregate("_listed", F.lit(0.0), lambda acc, e: acc + e["c"])
    rows = F.transform(
        "_listed", lambda e: F.struct(e["f"].alias("feature"), e["c"].alias("contribution"), e["v"].alias("value"))
    )
    rest = F.struct(
        F.lit("other").alias("feature"), (F.col("_total") - named).alias("contribution"), F.lit(None).cast("double").alias("value")
    )
    full = rows if len(features) <= shown else F.concat(rows, F.array(rest))
    return cases.select(key, listed.alias("_listed"), total.alias("_total")).select(
        key, F.posexplode(full).alias("place", "t")
    ).select(key, (F.col("place") + 1).alias("rank"), "t.*")
