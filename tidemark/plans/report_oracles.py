"""SQL of the reports: the statements of their tables, put under each other by column name."""

from __future__ import annotations

from tidemark.plans.oracles import ORACLES, SCORED, TX, _describe, _grid, split_of


def sections(parts: dict[str, str]) -> str:
    return " UNION ALL BY NAME ".join(f"SELECT '{name}' AS section, * FROM ({text})" for name, text in parts.items())


def on(split: str, text: str) -> str:
    """A statement over the scored rows, narrowed to one split."""
    return text.replace(SCORED, f"{SCORED.replace('scored AS (', 'every AS (')}{split_of('every')}, scored AS (SELECT TransactionID, TransactionDT, y, score FROM sp WHERE split = '{split}')")


def per_split(name: str) -> str:
    return " UNION ALL ".join(f"SELECT '{s}' AS split, * FROM ({on(s, ORACLES[name])})" for s in ("train", "val", "test"))


_METRICS = ORACLES["metrics_by_split"]
_TRIALS = f"SELECT trial, value FROM ({ORACLES['best_so_far']})"
_DENSITY = f"""WITH {SCORED}, r AS (
  SELECT y, CASE WHEN min(score) = max(score) THEN min(score) - 0.5 ELSE min(score) END AS a, CASE WHEN min(score) = max(score) THEN max(score) + 0.5 ELSE max(score) END AS b, count(*) AS n
  FROM scored GROUP BY y
), b AS (SELECT y, a, (b - a) / 120 AS w, n, CAST(least(floor((score - a) / ((b - a) / 120)), 119) AS BIGINT) AS bin FROM scored JOIN r USING (y))
SELECT y AS "isFraud", bin, CAST(count(*) AS BIGINT) AS n_rows, round(any_value(a) + bin * any_value(w) + 1e-9, 6) AS "left", round(count(*) / (any_value(n) * any_value(w)), 6) AS density FROM b GROUP BY y, bin"""
_CURVE = ORACLES["threshold_curve"]
_TOP = ORACLES["category_rate"]
_NUMERIC = ("TransactionAmt", "card1", "addr1", "rarely_missing", "mostly_missing", "TransactionDT")

ORACLES.update({
    "rep_1_score_distribution": sections({"density": _DENSITY, "stats": ORACLES["score_stats"], "roc": ORACLES["roc_curve"], "gain": ORACLES["gain_curve"], "gain_marks": ORACLES["gain_marks"]}),
    "rep_2_score_analysis": sections({"pr": ORACLES["pr_curve"], "deciles": ORACLES["decile_lift"], "correlations": ORACLES["score_corr"]}),
    "rep_3_anomaly_results": sections({
        "parameters": "SELECT * FROM (VALUES ('contamination', 0.035::DOUBLE), ('sample', 256), ('seed', 42), ('trees', 200)) AS p(parameter, setting)",
        "ranking": f"SELECT split, auroc, ap, ap_random FROM ({_METRICS}) WHERE split <> 'test'",
        "stats": on("train", ORACLES["score_stats"]), "flagging": on("train", ORACLES["topn_flagging"]),
    }),
    "rep_4_model_evaluation": sections({
        "roc": per_split("roc_curve"), "pr": per_split("pr_curve"),
        "thresholds": on("val", _CURVE.replace(_grid(190, 0.005), _grid(60, 0.01))), "confusion": on("test", ORACLES["confusion_rates"]),
    }),
    "rep_5_model_history": sections({"importance": ORACLES["stump_importance"], "history": ORACLES["best_so_far"]}),
    "rep_6_model_results": sections({"metrics": _METRICS, "best_trial": f"SELECT * FROM ({_TRIALS}) ORDER BY value DESC, trial LIMIT 1"}),
    "rep_7_test_curves": sections({name: on("test", ORACLES[source]) for name, source in (("roc", "roc_curve"), ("pr", "pr_curve"), ("point", "operating_point"))}),
    "rep_8_confusion": sections({"rates": on("test", ORACLES["confusion_rates"]), "scores": on("test", ORACLES["prf"])}),
    "rep_9_thresholds": sections({
        "curve": on("val", _CURVE), "best": f"SELECT threshold, f1 FROM ({on('val', _CURVE)}) ORDER BY f1 DESC, threshold LIMIT 1",
    }),
    "rep_10_contributions": sections({"mean_abs": ORACLES["mean_abs_contrib"], "beeswarm": ORACLES["contrib_long"]}),
    "rep_11_test_report": sections({
        "metrics": f"SELECT * EXCLUDE (split), 0.25::DOUBLE AS validation_f1 FROM ({_METRICS}) WHERE split = 'test'",
        "confusion": on("test", ORACLES["confusion_rates"]), "queue": on("test", ORACLES["review_queue"]),
    }),
    "rep_12_threshold_rerun": sections({
        "metrics": _METRICS,
        "caught": f"SELECT split, tp, tp + fn AS n_positive, round(100.0::DOUBLE * tp / (tp + fn), 6) AS pct_caught FROM ({_METRICS}) WHERE split <> 'train'",
    }),
    "rep_13_exploration": sections({
        "dtypes": "SELECT * FROM (VALUES ('bigint', 2::BIGINT), ('double', 6), ('int', 1), ('string', 7)) AS d(dtype, n_columns)",
        "families": ORACLES["column_families"], "classes": ORACLES["class_distribution"], "missing": ORACLES["missing_profile"],
        "most_missing": ORACLES["most_missing"].replace("LIMIT 5", "LIMIT 20"), "missing_bands": ORACLES["missing_bands"],
        "missing_summary": ORACLES["missing_summary"], "missing_histogram": ORACLES["missing_rate_histogram"], "label_correlations": ORACLES["label_corr"],
        "amount_histogram": ORACLES["histogram"], "amount_by_class": ORACLES["amount_by_class"], "amount_cut": _describe((0.995,)), "weekly": ORACLES["weekly_rate"],
    }),
    "rep_14_inspection": sections({
        "cardinality": ORACLES["cardinality"], "span": ORACLES["time_span"], "amount": _describe((0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)),
        "missing_by_family": ORACLES["missing_by_family"], "missing_summary": ORACLES["missing_summary"],
        "flag_values": f"SELECT * FROM ({ORACLES['distinct_values']}) WHERE \"column\" IN ('M1', 'M4')",
        "top_P_emaildomain": _TOP, "top_R_emaildomain": TX.join(t.replace("P_emaildomain", "R_emaildomain") for t in _TOP.split(TX)),
        "products": ORACLES["email_rates"].replace("P_emaildomain AS category", "ProductCD AS category").replace("P_emaildomain IS", "ProductCD IS"),
        "value_counts": f"SELECT * FROM ({ORACLES['value_counts']}) WHERE \"column\" = 'DeviceType'",
        "processed_dtypes": "SELECT * FROM (VALUES ('bigint', 2::BIGINT), ('double', 5), ('int', 1), ('string', 1)) AS d(dtype, n_columns)",
        "processed_missing": f"WITH {TX} SELECT CAST({' + '.join(f'count(*) - count({c})' for c in _NUMERIC)} AS BIGINT) AS n_missing FROM tx",
        "processed_rates": f"WITH {TX}{split_of('tx')} SELECT split, CAST(count(*) AS BIGINT) AS n_rows, round(avg(isFraud), 6) AS rate FROM sp GROUP BY split",
        "processed_low_variance": f"WITH {TX}{split_of('tx')}, s AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", stddev_samp({c}) AS std FROM train" for c in _NUMERIC)
        + ") SELECT \"column\", round(std, 6) AS std FROM s WHERE std < 0.01",
    }),
})
