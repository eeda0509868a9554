"""The batch job: load, split, encode, score anomalies, boost, choose a threshold."""

from __future__ import annotations

import json
import posixpath
from dataclasses import dataclass, field, replace

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import schema as S
from tidemark.operators import boosting, contributions, encoders, leafwise, thresholds
from tidemark.operators.curves import metrics_by_group
from tidemark.operators.isolation import AnomalyForest, AnomalyForestModel
from tidemark.operators.splitting import TemporalSplitModel, TemporalSplitter
from tidemark.operators.validate import load_dataset
from tidemark.session import written
from tidemark.settings import Settings
from tidemark.sources import files


@dataclass
class FeatureTable:
    """Fitted split and encoders with the lazily encoded rows of all splits."""

    splitter: TemporalSplitModel
    pipeline: PipelineModel
    rows: DataFrame
    raw_schema: T.StructType

    @property
    def features(self) -> list[str]:
        return encoders.final_encoder(self.pipeline).features

    def split(self, name: str) -> DataFrame:
        return self.rows.where(F.col(S.SPLIT) == name)


def build_features(merged: DataFrame, settings: Settings = Settings()) -> FeatureTable:
    """Everything is learned from the oldest rows only and applied to all of them."""
    splitter = TemporalSplitter(testSize=settings.test_size, valSize=settings.val_size).fit(merged)
    pipeline = encoders.build_pipeline(settings.missing_threshold, settings.smoothing).fit(
        splitter.select(merged, "train")
    )
    return FeatureTable(splitter, pipeline, pipeline.transform(splitter.transform(merged)), merged.schema)


@dataclass
class Bundle:
    """All that scoring needs: encoders, forest, trees, threshold, input types."""

    pipeline: PipelineModel
    forest: AnomalyForestModel
    trees: boosting.Ensemble
    threshold: float
    inputs: T.StructType
    version: str = "1.0"
    _columns: tuple[Column, Column] | None = field(default=None, init=False, repr=False)

    def columns(self, spark: SparkSession) -> tuple[Column, Column]:
        """Probability and contribution columns; the trees are shipped once per bundle."""
        if self._columns is None:
            terms, _ = contributions.contributions_column(spark, self.trees)
            self._columns = boosting.probability(boosting.log_odds_column(spark, self.trees)), terms
        return self._columns

    @property
    def features(self) -> list[str]:
        return self.trees.features

    def save(self, spark: SparkSession, path: str) -> None:
        self.pipeline.write().overwrite().save(posixpath.join(path, "pipeline"))
        self.forest.write().overwrite().save(posixpath.join(path, "forest"))
        self.trees.save(spark, posixpath.join(path, "trees"))
        facts = json.dumps({"threshold": self.threshold, "inputs": self.inputs.jsonValue(), "version": self.version})
        spark.createDataFrame([(facts,)], "value string").coalesce(1).write.mode("overwrite").text(
            posixpath.join(path, "facts")
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Bundle":
        if not files.table_exists(spark, posixpath.join(path, "facts")):
            raise FileNotFoundError(f"no fitted bundle at {path}: train and save one first")
        facts = json.loads(spark.read.text(posixpath.join(path, "facts")).first()[0])
        return cls(
            PipelineModel.load(posixpath.join(path, "pipeline")),
            AnomalyForestModel.load(posixpath.join(path, "forest")),
            boosting.Ensemble.load(spark, posixpath.join(path, "trees")),
            facts["threshold"], T.StructType.fromJson(facts["inputs"]), facts["version"],
        )


@dataclass
class Trained:
    """A bundle with the scored rows it was chosen on."""

    bundle: Bundle
    scored: DataFrame
    search_log: DataFrame | None
    validation_f1: float | None


def fit_forest(table: FeatureTable, settings: Settings) -> AnomalyForestModel:
    forest = AnomalyForest(
        inputCols=table.features, trees=settings.forest_trees, sampleSize=settings.forest_sample,
        contamination=settings.contamination, seed=settings.seed,
    )
    return forest.fit(table.split("train"))


def train(merged: DataFrame, settings: Settings = Settings(), params: leafwise.LeafParams | None = None) -> Trained:
    """Fit the whole chain; with no ``params`` the search picks them."""
    spark = merged.sparkSession
    table = build_features(merged, settings)
    # Encoded once: the forest, the trees and every report read this table.
    table = replace(table, rows=written(table.rows, "features"))
    forest = fit_forest(table, settings)
    rows = written(forest.transform(table.rows), "with-anomaly")
    features = [*table.features, S.SCORE]
    fit_rows, held = rows.where(F.col(S.SPLIT) == "train"), rows.where(F.col(S.SPLIT) == "val")
    log = None
    if params is None:
        log, params = leafwise.search_leafwise(
            fit_rows, held, features, settings.search_trials, sample_fraction=settings.search_sample,
            max_rounds=settings.search_rounds, patience=settings.search_patience, seed=settings.seed,
            timeout=settings.search_timeout,
        )
    trees = leafwise.fit_leafwise(
        fit_rows, held, features, params, max_rounds=settings.max_rounds, patience=settings.patience
    )
    scored = written(boosting.predict(rows, trees), "scored")
    threshold, f1 = thresholds.choose_threshold(
        scored.where(F.col(S.SPLIT) == "val"), "probability", S.LABEL
    )
    bundle = Bundle(
        table.pipeline, forest, trees, threshold, encoders.input_schema(table.pipeline, table.raw_schema)
    )
    return Trained(bundle, scored, log, f1)


def rescore(rows: DataFrame, trees: boosting.Ensemble) -> tuple[float, float | None, DataFrame]:
    """New threshold and metrics for a saved model, without training.

    ``rows`` are encoded rows with split and label. Returns the threshold, its
    validation F1 and the metrics of every split.
    """
    scored = written(
        boosting.predict(rows, trees).select(S.KEY, S.SPLIT, S.LABEL, "probability"), "rescored"
    )
    threshold, f1 = thresholds.choose_threshold(scored.where(F.col(S.SPLIT) == "val"), "probability", S.LABEL)
    return threshold, f1, metrics_by_group(scored, "probability", S.LABEL, threshold, [S.SPLIT])


def run(spark: SparkSession, settings: Settings, resume: bool = True) -> Trained:
    """The job over files: raw CSV pair in, merged table, feature table and bundle out."""
    merged_path = posixpath.join(settings.interim_dir, "merged.parquet")

    def merge() -> DataFrame:
        pair = [
            files.read_csv(spark, posixpath.join(settings.raw_dir, name))
            for name in (settings.transaction_file, settings.identity_file)
        ]
        return load_dataset(*pair)

    if resume:
        merged = files.unless_exists(spark, merged_path, merge)
    else:
        merged = spark.read.parquet(files.write_table(merge(), merged_path))
    trained = train(merged, settings)
    files.write_splits(trained.scored, posixpath.join(settings.processed_dir, "features.parquet"))
    trained.bundle.save(spark, posixpath.join(settings.processed_dir, "bundle"))
    return trained
