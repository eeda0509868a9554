"""Decision thresholds: the whole grid from one pass over the scores."""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions import sqltext as sql
from tidemark.operators.curves import precision_recall_f1

logger = logging.getLogger(__name__)

# The grids, as (start, stop, step) of a half-open range of doubles.
SEARCH_GRID = (0.01, 0.96, 0.01)
FINE_GRID = (0.01, 0.96, 0.005)
COARSE_GRID = (0.01, 0.61, 0.01)
DEFAULT_THRESHOLD = 0.5


def grid_values(grid: tuple[float, float, float]) -> list[float]:
    return [float(t) for t in np.arange(*grid)]


def threshold_curve(
    df: DataFrame, score: str, label: str, grid: tuple[float, float, float] = SEARCH_GRID, by: Sequence[str] = ()
) -> DataFrame:
    """``(by…, threshold, precision, recall, f1, tp, fp, fn, tn)`` at every grid value.

    Each score falls in one grid cell (binary search against the grid's own doubles),
    rows combine per cell before the shuffle, and suffix sums run over a cell table
    whose size is the grid's.
    """
    values = grid_values(grid)
    rows = df.select(*by, F.col(score).cast("double").alias("_s"), F.col(label).alias("_y")).where(
        F.col("_s").isNotNull() & F.col("_y").isNotNull()
    )
    cells = (
        # Cell i holds the scores with exactly i grid values at or below them.
        Bucketizer(splits=[-math.inf, *values, math.inf], inputCol="_s", outputCol="_cell", handleInvalid="skip")
        .transform(rows)
        .groupBy(*by, F.col("_cell").cast("int").alias("_cell"))
        .agg(F.count_if(F.col("_y") == 1).alias("_p"), F.count_if(F.col("_y") != 1).alias("_n"))
    )
    groups = cells.groupBy(*by).agg(
        F.sum("_p").alias("_pos"), F.sum("_n").alias("_neg"),
        F.collect_list(F.struct("_cell", "_p", "_n")).alias("_cells"),
    ).where(F.col("_pos").isNotNull())  # without rows there is no curve
    steps = sql.rows_of([f"named_struct('cell', {i + 1}, 't', {sql.number(t)})" for i, t in enumerate(values)])
    expanded = groups.select(*by, "_pos", "_neg", "_cells", steps.alias("_g"))

    def flagged(field: str):
        reached = F.filter("_cells", lambda c: c["_cell"] >= F.col("_g.cell"))
        return F.aggregate(reached, F.lit(0).cast("long"), lambda total, c: total + c[field])

    counts = expanded.select(
        *by, F.col("_g.t").alias("threshold"), flagged("_p").alias("tp"), flagged("_n").alias("fp"), "_pos", "_neg"
    ).select(
        *by, "threshold", "tp", "fp", (F.col("_pos") - F.col("tp")).alias("fn"), (F.col("_neg") - F.col("fp")).alias("tn")
    )
    return counts.select(*by, "threshold", *precision_recall_f1(), "tp", "fp", "fn", "tn")


def best_threshold(
    df: DataFrame, score: str, label: str, grid: tuple[float, float, float] = SEARCH_GRID, by: Sequence[str] = ()
) -> DataFrame:
    """``(by…, threshold, f1)`` of the first grid value with the highest F1."""
    curve = threshold_curve(df, score, label, grid, by)
    best = F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("t"))).alias("best")
    return curve.groupBy(*by).agg(best).where(F.col("best").isNotNull()).select(
        *by, F.round(-F.col("best.t"), 6).alias("threshold"), F.col("best.f1").alias("f1")
    )


def choose_threshold(validation: DataFrame, score: str, label: str) -> tuple[float, float | None]:
    """The validation rows' best threshold; 0.5 with a warning when there are none."""
    row = best_threshold(validation, score, label).first()
    if row is None:
        logger.warning("no validation rows: threshold falls back to %.2f", DEFAULT_THRESHOLD)
        return DEFAULT_THRESHOLD, None
    return row["threshold"], row["f1"]


def best_so_far(trials: DataFrame, trial: str, value: str) -> DataFrame:
    """Running maximum over a trial log, which has a row per trial."""
    upto = Window.partitionBy(F.lit(0)).orderBy(trial).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return trials.select(trial, value, F.max(value).over(upto).alias("best"))
