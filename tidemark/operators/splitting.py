"""Time-ordered splits and exact-size samples, both as plain key predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark import schema as S
from tidemark.functions.scalars import portable_hash
from tidemark.operators.ordering import CutKey, cut_keys


class _SplitParams(Params):
    timeCol = Param(Params._dummy(), "timeCol", "column the rows are ordered by", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "unique key that breaks ties in time", TypeConverters.toString)
    testSize = Param(Params._dummy(), "testSize", "newest share of the rows", TypeConverters.toFloat)
    valSize = Param(Params._dummy(), "valSize", "share before the newest", TypeConverters.toFloat)
    cuts = Param(Params._dummy(), "cuts", "fitted cut keys: [time, key] of the first val and test row")

    def __init__(self):
        super().__init__()
        self._setDefault(timeCol=S.TIME, keyCol=S.KEY, testSize=0.2, valSize=0.15)


class TemporalSplitter(Estimator, _SplitParams, DefaultParamsReadable, DefaultParamsWritable):
    """Oldest rows to ``train``, then ``val``, newest to ``test``; ties break by key.

    Fitting finds the two rows where the splits begin. The split of a row is then a
    comparison with two literals: no sort, no shuffle, and pushed into the scan when
    one split is selected.
    """

    @keyword_only
    def __init__(self, *, timeCol=S.TIME, keyCol=S.KEY, testSize=0.2, valSize=0.15):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "TemporalSplitModel":
        time, key = self.getOrDefault("timeCol"), self.getOrDefault("keyCol")
        test, val = self.getOrDefault("testSize"), self.getOrDefault("valSize")

        # The truncation must happen in the same floating-point arithmetic everywhere.
        def starts(n: int) -> list[int]:
            return [int(n * (1 - test - val)), int(n * (1 - test))]

        keys, _ = cut_keys(df.select(time, key), time, key, [1 - test - val, 1 - test], starts)
        model = TemporalSplitModel()
        self._copyValues(model)
        return model._set(cuts=[[k.first, k.second] for k in keys])


class TemporalSplitModel(Model, _SplitParams, DefaultParamsReadable, DefaultParamsWritable):
    def _cut(self, index: int) -> CutKey:
        return CutKey(*self.getOrDefault("cuts")[index])

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = self.getOrDefault("timeCol"), self.getOrDefault("keyCol")
        split = (
            F.when(self._cut(0).before(*columns), "train")
            .when(self._cut(1).before(*columns), "val")
            .otherwise("test")
        )
        return df.withColumn(S.SPLIT, split)

    def predicate(self, split: str) -> Column:
        """Condition of one split in a form the scan can use."""
        columns = self.getOrDefault("timeCol"), self.getOrDefault("keyCol")
        if split == "train":
            return self._cut(0).before(*columns)
        if split == "val":
            return self._cut(0).not_before(*columns) & self._cut(1).before(*columns)
        return self._cut(1).not_before(*columns)

    def select(self, df: DataFrame, split: str) -> DataFrame:
        return df.where(self.predicate(split)).withColumn(S.SPLIT, F.lit(split))


def split_summary(df: DataFrame) -> DataFrame:
    """Rows, share, positive rate and time range of every split."""
    per_split = df.groupBy(S.SPLIT).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col(S.LABEL).cast("double")).alias("rate"),
        F.min(S.TIME).alias("dt_min"),
        F.max(S.TIME).alias("dt_max"),
    )
    # Three rows at most reach this window.
    everything = Window.partitionBy(F.lit(0))
    return per_split.select(
        S.SPLIT, "n_rows", (F.col("n_rows") / F.sum("n_rows").over(everything)).alias("share"),
        "rate", "dt_min", "dt_max",
    )


def split_overlap(df: DataFrame, key: str = S.KEY) -> DataFrame:
    """Keys that occur in more than one split (none, when the split is sound)."""
    return (
        df.groupBy(key)
        .agg(F.min(S.SPLIT).alias("low"), F.max(S.SPLIT).alias("high"))
        .where(F.col("low") != F.col("high"))
        .select(key)
    )


def smallest_hashes(df: DataFrame, key: str, size, share: float, seed: int) -> DataFrame:
    """The ``size(row count)`` rows with the smallest key hash; ties break by key.

    The same rows are chosen on every run and every retry.
    """
    hashed = df.withColumn("_hash", portable_hash(F.col(key), seed))
    [cut], _ = cut_keys(hashed.select("_hash", key), "_hash", key, [share], lambda n: [size(n)])
    return hashed.where(cut.before("_hash", key)).drop("_hash")


def stratified_sample(
    df: DataFrame, label: str = S.LABEL, key: str = S.KEY, fraction: float = 0.3, seed: int = 42,
    classes: Sequence[int] = (1, 0),
) -> DataFrame:
    """Exactly ``max(1, int(n * fraction))`` rows of every class, without replacement.

    A fraction outside (0, 1) turns sampling off.
    """
    if not 0.0 < fraction < 1.0:
        return df
    parts = [
        smallest_hashes(df.where(F.col(label) == c), key, lambda n: max(1, int(n * fraction)), fraction, seed)
        for c in classes
    ]
    sample = parts[0]
    for part in parts[1:]:
        sample = sample.unionByName(part)
    return sample


def uniform_sample(df: DataFrame, rows: int, key: str = S.KEY, seed: int = 42) -> DataFrame:
    """``min(rows, n)`` rows without replacement: a sampling operator, not a row cap."""
    total = df.count()
    if total <= rows:
        return df
    return smallest_hashes(df, key, lambda n: rows, rows / total, seed)
