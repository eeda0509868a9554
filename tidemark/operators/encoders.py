"""Leakage-free feature transforms: learned on the training rows, applied everywhere.

Every transform is an ``Estimator``/``Model`` pair (the stateless amount features are a
``Transformer``). Fitting is a few aggregates; applying is projections and keyed
lookups. Key, label and split columns pass through untouched, so rows keep their
identity and nothing depends on row positions.
"""

from __future__ import annotations

import posixpath
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemark import schema as S
from tidemark.functions import scalars as X, sqltext as sql
from tidemark.operators.joins import hot_keys, lookup
from tidemark.operators.ordering import exact_quantiles
from tidemark.operators.profile import missing_profile, numeric_columns, string_columns
from tidemark.session import written



def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in S.PASSTHROUGH]


class _Stage(Params):
    """Parameters every transform shares."""

    threshold = Param(Params._dummy(), "threshold", "largest missing share to keep", TypeConverters.toFloat)
    smoothing = Param(Params._dummy(), "smoothing", "pseudo-rows at the global rate", TypeConverters.toFloat)
    inputCols = Param(Params._dummy(), "inputCols", "columns to encode", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    state = Param(Params._dummy(), "state", "what fitting learned, as plain values")

    def learned(self, name: str):
        return self.getOrDefault("state")[name]


# ----------------------------------------------------------- fitted tables persistence


class _TableWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        if self.instance.table is not None:
            self.instance.table.write.parquet(posixpath.join(path, "table"))


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        instance = self.cls()
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        if instance.learned("has_table"):
            instance.table = self.sparkSession.read.parquet(posixpath.join(path, "table"))
        return instance


class _TableModel(Model, _Stage, MLWritable):
    """Model whose fitted lookup table is data, not a driver-side dictionary."""

    table: DataFrame | None = None

    def write(self):
        return _TableWriter(self)

    @classmethod
    def read(cls):
        return _TableReader(cls)

    @classmethod
    def load(cls, path):
        return cls.read().load(path)

    def hot(self, column: str) -> list[str] | None:
        """Hot keys of a column whose table is large; None when it is small."""
        return None if self.learned("hot") is None else self.learned("hot").get(column, [])

    def entries(self, column: str) -> DataFrame:
        """The fitted ``key -> value`` rows of one column."""
        return self.table.where(F.col("column") == column).select("category", "value")


# ------------------------------------------------------------------------- missing cut


class HighMissingDropper(Estimator, _Stage, DefaultParamsReadable, DefaultParamsWritable):
    """Drops columns whose training missing rate is strictly above the threshold."""

    @keyword_only
    def __init__(self, *, threshold=0.7):
        super().__init__()
        self._setDefault(threshold=0.7)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "HighMissingDropperModel":
        cut = self.getOrDefault("threshold")
        rates = missing_profile(df, feature_columns(df)).where(F.col("missing_rate") > cut)
        drop = {row["column"] for row in rates.select("column").collect()}
        model = HighMissingDropperModel()
        return model._set(state={"drop": [c for c in df.columns if c in drop]})


class HighMissingDropperModel(Model, _Stage, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.learned("drop"))


# ---------------------------------------------------------------------- time and amount


class TimeFeatures(Estimator, _Stage, DefaultParamsReadable, DefaultParamsWritable):
    """Hour, relative weekday, weekend flag, position in the training window."""

    def __init__(self):
        super().__init__()

    def _fit(self, df: DataFrame) -> "TimeFeaturesModel":
        row = df.agg(F.min(S.TIME), F.max(S.TIME)).first()
        return TimeFeaturesModel()._set(state={"start": float(row[0]), "end": float(row[1])})


class TimeFeaturesModel(Model, _Stage, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, df: DataFrame) -> DataFrame:
        dt = F.col(S.TIME)
        return df.select(
            *[c for c in df.columns if c != S.TIME],
            X.hour_of_day(dt).alias("hour_of_day"),
            X.day_of_week(dt).alias("day_of_week"),
            X.is_weekend(dt).alias("is_weekend"),
            X.time_in_dataset(dt, self.learned("start"), self.learned("end")).alias("time_in_dataset"),
        )


class AmountFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Log amount and right-closed amount band; the amount stays."""

    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        amount = F.col(S.AMOUNT)
        return df.select("*", X.amount_log(amount).alias("amt_log"), X.amount_band(amount).alias("amt_bin"))


# ---------------------------------------------------------------------- target encoding


def category_sums(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """``(column, category, hits, n)``, the missing category included.

    All columns share one pass and one shuffle, and counts combine before it.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("category")) for c in columns])
    long = df.select(F.col(label).cast("double").alias("y"), F.explode(pairs).alias("p"))
    return long.groupBy(F.col("p.column").alias("column"), F.col("p.category").alias("category")).agg(
        F.sum("y").alias("hits"), F.count("y").alias("n")
    )


class TargetRateEncoder(Estimator, _Stage, DefaultParamsReadable, DefaultParamsWritable):
    """Smoothed label rate of a category; unseen and missing get the global rate.

    rate = (hits + smoothing x global) / (n + smoothing)
    """

    @keyword_only
    def __init__(self, *, inputCols=list(S.EMAIL_COLUMNS), smoothing=10.0, labelCol=S.LABEL):
        super().__init__()
        self._setDefault(inputCols=list(S.EMAIL_COLUMNS), smoothing=10.0, labelCol=S.LABEL)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "TargetRateEncoderModel":
        label, smoothing = self.getOrDefault("labelCol"), self.getOrDefault("smoothing")
        columns = [c for c in self.getOrDefault("inputCols") if c in df.columns]
        model = TargetRateEncoderModel()
        if columns:
            model.table = written(category_sums(df, columns, label), "rates")
            # Any one column's categories, the missing one included, cover all rows.
            prior = (
                model.table.where(F.col("column") == columns[0]).agg(F.sum("hits") / F.sum("n")).first()[0]
            )
        else:
            prior = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
        return model._set(
            state={
                "columns": columns, "all": self.getOrDefault("inputCols"), "prior": prior,
                "smoothing": smoothing, "hot": hot_keys(model.table) if columns else None,
                "has_table": bool(columns),
            }
        )


class TargetRateEncoderModel(_TableModel):
    def entries(self, column: str) -> DataFrame:
        prior, smoothing = self.learned("prior"), self.learned("smoothing")
        rate = (F.col("hits") + F.lit(smoothing * prior)) / (F.col("n") + F.lit(float(smoothing)))
        known = (F.col("column") == column) & F.col("category").isNotNull()
        return self.table.where(known).select("category", rate.alias("value"))

    def _transform(self, df: DataFrame) -> DataFrame:
        for column in self.learned("all"):
            if column not in df.columns:
                continue
            if column in self.learned("columns"):
                df = lookup(
                    df, self.entries(column), column, "value", self.learned("prior"), f"{column}_risk", self.hot(column)
                )
            else:
                df = df.withColumn(f"{column}_risk", F.lit(self.learned("prior")))
            df = df.drop(column)
        return df


# ------------------------------------------------------------------------ final encoding


def ordinal_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, category, value, n)``: 0-based rank of each category in sorted order, and its rows.

    Categories are counted before they are ranked, one row each, and ranked by a
    range-partitioned sort, so that no task has to hold a column's categories.
    The sorted table is written first, so every row's place in it is fixed even when
    a task is retried.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("category")) for c in columns])
    distinct = (
        df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("category").isNotNull())
        .groupBy("column", "category").agg(F.count(F.lit(1)).alias("n"))
    )
    placed = written(
        distinct.orderBy("column", "category").select(
            "column", "category", "n",
            F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
        ),
        "sorted",
    )
    # A row per (sort partition, column).
    runs = placed.groupBy("column", "part").agg(F.count(F.lit(1)).alias("size"), F.min("place").alias("start"))
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        "column", "part", "start", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")
    )
    return placed.join(offsets, ["column", "part"]).select(
        "column", "category", (F.col("offset") + F.col("place") - F.col("start")).cast("int").alias("value"), "n"
    )


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per numeric column: ``(feature, n, value)``."""
    return exact_quantiles(df, columns, [0.5]).select("feature", "n", F.col("q0").alias("value"))


class FinalEncoder(Estimator, _Stage, DefaultParamsReadable, DefaultParamsWritable):
    """Flags to 1/0/-1, strings to sorted ordinal codes, numbers to DOUBLE with medians.

    Column types are looked at when fitting. Unseen and missing strings become -1.
    """

    def __init__(self):
        super().__init__()

    def _fit(self, df: DataFrame) -> "FinalEncoderModel":
        features = feature_columns(df)
        flags = [c for c in S.BINARY_FLAGS if c in features]
        strings = set(string_columns(df))
        tri = [S.TRI_FLAG] if S.TRI_FLAG in features else []
        categories = [c for c in features if c in strings and c not in flags and c not in tri]
        numbers = [c for c in numeric_columns(df) if c in features]
        fill = {row["feature"]: row["value"] for row in medians(df, numbers).collect()}
        empty = [c for c in numbers if c not in fill]
        if empty:
            raise ValueError(f"no training value to take a median of: {empty}")
        model = FinalEncoderModel()
        hot = None
        if tri + categories:
            model.table = written(ordinal_codes(df, tri + categories), "codes")
            hot = hot_keys(model.table)
        return model._set(
            state={
                "flags": flags, "tri": tri, "categories": categories, "numbers": numbers, "fill": fill,
                "features": [c for c in features if c in {*flags, *tri, *categories, *numbers}],
                "hot": hot, "has_table": bool(tri + categories),
            }
        )


class FinalEncoderModel(_TableModel):
    @property
    def features(self) -> list[str]:
        """Output features in order."""
        return list(self.learned("features"))

    @property
    def fill(self) -> dict[str, float]:
        """Value that stands for a missing one, per feature."""
        codes = self.learned("flags") + self.learned("tri") + self.learned("categories")
        return {**self.learned("fill"), **{c: -1.0 for c in codes}}

    def _transform(self, df: DataFrame) -> DataFrame:
        for column in self.learned("tri") + self.learned("categories"):
            coded = lookup(df, self.entries(column), column, "value", -1, "_code", self.hot(column))
            df = coded.drop(column).withColumnRenamed("_code", column)
        flags, fill = set(self.learned("flags")), self.learned("fill")
        types = {f.name: f.dataType for f in df.schema}
        columns = [F.col(c) for c in S.PASSTHROUGH if c in df.columns]
        for name in self.learned("features"):
            column = sql.name(name)
            if name in flags:
                columns.append(X.flag_code(F.col(name)).alias(name))
            elif name in fill:
                held = f"CASE WHEN NOT {sql.is_missing(name, types[name])} THEN CAST({column} AS DOUBLE) END"
                columns.append(F.expr(f"coalesce({held}, {sql.number(float(fill[name]))}) AS {column}"))
            else:
                columns.append(F.col(name))
        return df.select(*columns)


# ----------------------------------------------------------------------------- pipeline


def build_pipeline(missing_threshold: float = 0.7, smoothing: float = 10.0) -> Pipeline:
    """The unfitted chain; fit it on training rows only."""
    return Pipeline(
        stages=[
            HighMissingDropper(threshold=missing_threshold),
            TimeFeatures(),
            AmountFeatures(),
            TargetRateEncoder(smoothing=smoothing),
            FinalEncoder(),
        ]
    )


def final_encoder(pipeline: PipelineModel) -> FinalEncoderModel:
    return pipeline.stages[-1]


def input_columns(pipeline: PipelineModel) -> list[str]:
    """Raw columns the fitted chain consumes, in order, without duplicates."""
    _, _, _, rates, final = pipeline.stages
    engineered = {"hour_of_day", "day_of_week", "is_weekend", "time_in_dataset", "amt_log", "amt_bin"}
    risk = {f"{c}_risk": c for c in rates.learned("columns")}
    numbers = [risk.get(c, c) for c in final.learned("numbers") if c not in engineered]
    return list(
        dict.fromkeys([S.TIME, *numbers, *final.learned("categories"), *final.learned("flags"), *final.learned("tri")])
    )


def input_schema(pipeline: PipelineModel, raw: T.StructType) -> T.StructType:
    """Types of :func:`input_columns` as they were in the training table."""
    return T.StructType([raw[c] for c in input_columns(pipeline)])


def pipeline_summary(spark: SparkSession, pipeline: PipelineModel) -> DataFrame:
    """``(step, metric, value)`` rows that say what the fitted chain does."""
    dropper, _, _, rates, final = pipeline.stages
    rows = [
        ("missing", "columns_dropped", len(dropper.learned("drop"))),
        ("time", "columns_added", 4),
        ("amount", "columns_added", 2),
        ("rates", "columns_encoded", len(rates.learned("columns"))),
        ("encode", "binary_flags", len(final.learned("flags"))),
        ("encode", "tri_flag_present", len(final.learned("tri"))),
        ("encode", "categorical", len(final.learned("categories"))),
        ("encode", "numeric_imputed", len(final.learned("numbers"))),
        ("encode", "features_out", len(final.features)),
    ]
    return spark.createDataFrame(rows, "step string, metric string, value int")
