"""Report tables: each report is a dictionary of named, lazy DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark import schema as S
from tidemark.functions import scalars as X, sqltext as sql
from tidemark.operators import boosting, contributions as C, curves as R, profile as P, thresholds as H
from tidemark.operators.splitting import uniform_sample

Report = dict[str, DataFrame]

# Percentiles and bin counts of the exploration tables.
AMOUNT_PROBS = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
CLASS_PROBS = (0.25, 0.5, 0.75)
AMOUNT_BINS, SCORE_BINS, RATE_BINS = 80, 120, 50


def exploration(df: DataFrame) -> Report:
    """Shape, classes, missing values, correlations, amounts, weeks."""
    return {
        "dtypes": P.dtype_counts(df),
        "families": P.column_families(df),
        "classes": P.class_distribution(df),
        "missing": P.missing_profile(df),
        "most_missing": P.most_missing(df),
        "missing_bands": P.missing_bands(df),
        "missing_summary": P.missing_summary(df),
        "missing_histogram": P.missing_rate_histogram(df, RATE_BINS),
        "label_correlations": P.label_correlations(df),
        "amount_histogram": P.histogram(df, S.AMOUNT, AMOUNT_BINS, [S.LABEL]),
        "amount_by_class": P.describe(df, S.AMOUNT, CLASS_PROBS, [S.LABEL]),
        "amount_cut": P.describe(df, S.AMOUNT, [0.995]),
        "weekly": P.weekly_rate(df),
    }


def raw_inspection(df: DataFrame) -> Report:
    """Quick look at a merged table; parts whose columns are absent are left out."""
    names = df.columns
    report = {
        "cardinality": P.cardinality(df),
        "span": P.time_span(df),
        "amount": P.describe(df, S.AMOUNT, AMOUNT_PROBS),
        "missing_by_family": P.missing_by_family(df),
        "missing_summary": P.missing_summary(df),
    }
    flags = [c for c in names if S.family_of(c) == "M"]
    if flags:
        report["flag_values"] = P.distinct_values(df, flags)
    for column in S.EMAIL_COLUMNS:
        if column in names:
            report[f"top_{column}"] = P.top_categories(df, column)
    if "ProductCD" in names:
        report["products"] = P.category_rates(df, "ProductCD")
    counted = [c for c in ("card4", "card6", "DeviceType") if c in names]
    if counted:
        report["value_counts"] = P.value_counts(df, counted)
    for family, title in (("C", "counts"), ("D", "deltas")):
        members = [c for c in names if S.family_of(c) == family]
        if members:
            report[title] = P.family_stats(df, members)
    return report


def processed_inspection(rows: DataFrame, features: Sequence[str], codes: Sequence[str] = ()) -> Report:
    """Sanity of an encoded table: missing cells, rates, code values, near-constant columns."""
    report = {
        "dtypes": P.dtype_counts(rows),
        "missing": P.missing_cells(rows.select(*features)),
        "rates": rows.groupBy(S.SPLIT).agg(
            F.count(F.lit(1)).alias("n_rows"), F.avg(F.col(S.LABEL).cast("double")).alias("rate")
        ),
        "low_variance": P.low_variance(rows.where(F.col(S.SPLIT) == "train"), features),
    }
    if codes:
        report["code_values"] = P.distinct_values(rows, codes)
    return report


def score_distribution(train: DataFrame, score: str = S.SCORE, label: str = S.LABEL, key: str = S.KEY) -> Report:
    """Density per class, statistics, ROC and gain curves of the anomaly score (training rows)."""
    return {
        "density": P.histogram(train, score, SCORE_BINS, [label]),
        "stats": R.score_stats(train, score, label),
        "roc": R.roc_curve(train, score, label),
        "gain": R.gain_curve(train, score, key, label),
        "gain_marks": R.gain_marks(train, score, key, label),
    }


def score_analysis(
    train: DataFrame, features: Sequence[str], score: str = S.SCORE, label: str = S.LABEL, splits: DataFrame | None = None
) -> Report:
    """Precision-recall per split, lift per decile, features that move with the score."""
    pr = R.pr_curve(train, score, label) if splits is None else R.pr_curve(splits, score, label, [S.SPLIT])
    return {
        "pr": pr,
        "deciles": R.decile_lift(train, score, label),
        "correlations": P.top_correlations(train, score, [f for f in features if f != score], 20),
    }


def anomaly_results(rows: DataFrame, parameters: dict[str, float], score: str = S.SCORE, label: str = S.LABEL) -> Report:
    """Forest parameters, ranking per split, class separation and flagging (training rows)."""
    seen = rows.where(F.col(S.SPLIT) != "test")
    train = rows.where(F.col(S.SPLIT) == "train")
    listed = sorted((name, float(value)) for name, value in parameters.items())
    return {
        "parameters": rows.sparkSession.createDataFrame(listed, "parameter string, value double"),
        "ranking": R.ranking_metrics(seen, score, label, [S.SPLIT]),
        "stats": R.score_stats(train, score, label),
        "flagging": R.topn_flagging(train, score, label),
    }


def model_evaluation(rows: DataFrame, threshold: float, score: str = "probability", label: str = S.LABEL) -> Report:
    """Curves per split, the coarse threshold curve (validation) and the confusion matrix (test)."""
    test = rows.where(F.col(S.SPLIT) == "test")
    return {
        "roc": R.roc_curve(rows, score, label, [S.SPLIT]),
        "pr": R.pr_curve(rows, score, label, [S.SPLIT]),
        "thresholds": H.threshold_curve(rows.where(F.col(S.SPLIT) == "val"), score, label, H.COARSE_GRID),
        "confusion": R.confusion_rates(R.confusion(test, score, label, threshold)),
    }


def model_history(trees: boosting.Ensemble, log: DataFrame) -> Report:
    """Strongest features by gain, and the best value so far of the search."""
    return {
        "importance": boosting.importance(trees, log.sparkSession),
        "history": H.best_so_far(log, "trial", "value"),
    }


def model_results(rows: DataFrame, log: DataFrame | None, threshold: float, score: str = "probability") -> Report:
    report = {"metrics": R.metrics_by_group(rows, score, S.LABEL, threshold, [S.SPLIT])}
    if log is not None:
        report["best_trial"] = log.orderBy(F.col("value").desc(), "trial").limit(1)
    return report


def test_curves(test: DataFrame, threshold: float, score: str = "probability") -> Report:
    return {
        "roc": R.roc_curve(test, score, S.LABEL),
        "pr": R.pr_curve(test, score, S.LABEL),
        "point": R.operating_point(test, score, S.LABEL, threshold),
    }


def confusion_report(test: DataFrame, threshold: float, score: str = "probability") -> Report:
    counts = R.confusion(test, score, S.LABEL, threshold)
    return {"rates": R.confusion_rates(counts), "scores": counts.select(*R.precision_recall_f1())}


def threshold_report(validation: DataFrame, score: str = "probability") -> Report:
    return {
        "curve": H.threshold_curve(validation, score, S.LABEL, H.FINE_GRID),
        "best": H.best_threshold(validation, score, S.LABEL, H.FINE_GRID),
    }


def contribution_overview(
    rows: DataFrame, features: Sequence[str], terms: str, values: str, key: str = S.KEY, sample: int | None = 5_000
) -> Report:
    """Mean absolute terms, and the long rows behind a beeswarm of the strongest features.

    The sample is the report's own operator; ``None`` explains every row.
    """
    chosen = rows if sample is None else uniform_sample(rows, sample, key)
    means = C.mean_abs_contributions(chosen, features, terms)
    long = C.contribution_rows(chosen, key, features, terms, values)
    return {"mean_abs": means, "beeswarm": long.join(F.broadcast(means.select("feature")), "feature", "left_semi")}


def explained_cases(
    test: DataFrame, trees: boosting.Ensemble, threshold: float, score: str = "probability", cases: int = 5, shown: int = 15
) -> Report:
    """The most confident true positives and their largest terms; only they are explained."""
    top = R.true_positives(test, score, S.LABEL, threshold, S.KEY, cases)
    terms, base = C.contributions_column(test.sparkSession, trees)
    held = top.select(S.KEY, score, terms.alias("_t"), sql.double_array(trees.features).alias("_v"))
    return {
        "cases": held.select(S.KEY, score, F.lit(base).alias("base")),
        "terms": C.case_terms(held, S.KEY, trees.features, "_t", "_v", shown),
    }


def test_report(test: DataFrame, threshold: float, validation_f1: float | None, score: str = "probability") -> Report:
    counts = R.confusion(test, score, S.LABEL, threshold)
    return {
        "metrics": R.metrics_by_group(test, score, S.LABEL, threshold).withColumn(
            "validation_f1", F.lit(validation_f1).cast("double")
        ),
        "confusion": R.confusion_rates(counts),
        "queue": R.review_queue(counts),
    }


def threshold_rerun(rows: DataFrame, threshold: float, score: str = "probability") -> Report:
    """Metrics per split at a re-derived threshold, and the share of positives caught."""
    metrics = R.metrics_by_group(rows, score, S.LABEL, threshold, [S.SPLIT])
    caught = metrics.where(F.col(S.SPLIT).isin("val", "test")).select(
        S.SPLIT, "tp", (F.col("tp") + F.col("fn")).alias("n_positive"),
        (X.ratio(F.col("tp"), F.col("tp") + F.col("fn")) * 100).alias("pct_caught"),
    )
    return {"metrics": metrics, "caught": caught}
