"""The reports as queries: every table of a report as a section of one wide result.

A report's source is narrowed to the columns it needs and written once, so that its many tables
read that and not the base tables again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark import schema as S
from tidemark.plans import queries as Q, reports
from tidemark.operators import thresholds as H
from tidemark.session import written
from tidemark.sources import tables

# Settings listed by the anomaly report, and a validation score shown by the test report.
PARAMETERS = {"contamination": 0.035, "sample": 256.0, "seed": 42.0, "trees": 200.0}
VALIDATION_F1 = 0.25
NUMERIC = [S.AMOUNT, "card1", "addr1", "rarely_missing", "mostly_missing", S.TIME]


def sections(report: reports.Report) -> DataFrame:
    """All tables of a report under each other; columns a table lacks are NULL."""
    named = [table.withColumn("section", F.lit(name)) for name, table in report.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def scored(spark, folder) -> DataFrame:
    """Key, split, label and score, written once for all tables of a report."""
    rows = Q.scored_split(spark, folder)
    return written(rows.select(S.KEY, S.SPLIT, F.col("y").alias(S.LABEL), "score"), "report")


def part(rows: DataFrame, name: str) -> DataFrame:
    return rows.where(F.col(S.SPLIT) == name)


def trials(rows: DataFrame) -> DataFrame:
    """F1 over thresholds, taken as numbered trials of a search."""
    curve = H.threshold_curve(rows, "score", S.LABEL)
    return curve.select(F.round(F.col("threshold") * 100).cast("int").alias("trial"), F.col("f1").alias("value"))


@Q.query
def rep_1_score_distribution(spark, folder):
    report = reports.score_distribution(scored(spark, folder), "score")
    # A bin can begin right between two rounded values, where engines round apart.
    report["density"] = report["density"].withColumn("left", F.col("left") + 1e-9)
    report["gain"] = report["gain"].select("key", "rank", "share_flagged", "capture")
    return sections(report)


@Q.query
def rep_2_score_analysis(spark, folder):
    rows = Q.tx(spark, folder).withColumn("score", tables.score_column()).select(S.KEY, S.LABEL, "score", *NUMERIC)
    return sections(reports.score_analysis(written(rows, "report"), NUMERIC, "score"))


@Q.query
def rep_3_anomaly_results(spark, folder):
    report = reports.anomaly_results(scored(spark, folder), PARAMETERS, "score")
    report["ranking"] = report["ranking"].select(S.SPLIT, "auroc", "ap", "ap_random")
    # The settings' value would share its name with nothing else here, but not its meaning.
    report["parameters"] = report["parameters"].withColumnRenamed("value", "setting")
    return sections(report)


@Q.query
def rep_4_model_evaluation(spark, folder):
    return sections(reports.model_evaluation(scored(spark, folder), Q.THRESHOLD, "score"))


@Q.query
def rep_5_model_history(spark, folder):
    return sections(reports.model_history(Q.stump_trees(spark, folder), trials(scored(spark, folder))))


@Q.query
def rep_6_model_results(spark, folder):
    rows = scored(spark, folder)
    return sections(reports.model_results(rows, trials(rows), Q.THRESHOLD, "score"))


@Q.query
def rep_7_test_curves(spark, folder):
    return sections(reports.test_curves(part(scored(spark, folder), "test"), Q.THRESHOLD, "score"))


@Q.query
def rep_8_confusion(spark, folder):
    return sections(reports.confusion_report(part(scored(spark, folder), "test"), Q.THRESHOLD, "score"))


@Q.query
def rep_9_thresholds(spark, folder):
    return sections(reports.threshold_report(part(scored(spark, folder), "val"), "score"))


@Q.query
def rep_10_contributions(spark, folder):
    rows = written(tables.explained(Q.tx(spark, folder)), "report")
    return sections(reports.contribution_overview(rows, Q.TERM_NAMES, "terms", "values", sample=None))


@Q.query
def rep_11_test_report(spark, folder):
    return sections(reports.test_report(part(scored(spark, folder), "test"), Q.THRESHOLD, VALIDATION_F1, "score"))


@Q.query
def rep_12_threshold_rerun(spark, folder):
    return sections(reports.threshold_rerun(scored(spark, folder), Q.THRESHOLD, "score"))


@Q.query
def rep_13_exploration(spark, folder):
    return sections(reports.exploration(Q.merged_once(spark, folder)))


@Q.query
def rep_14_inspection(spark, folder):
    """The raw table, and sanity of its numeric columns per split."""
    raw = reports.raw_inspection(Q.merged_once(spark, folder))
    rows, _ = Q.train_rows(spark, folder)
    rows = written(rows.select(S.KEY, S.SPLIT, S.LABEL, *NUMERIC), "report")
    processed = reports.processed_inspection(rows, NUMERIC)
    return sections(raw | {f"processed_{name}": table for name, table in processed.items()})
