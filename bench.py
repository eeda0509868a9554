"""Seconds per headline query, warm, on the tables at ``$BENCH_SF_DIR``; one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import queries as Q  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = (
    "risk_by_split", "merge_identity", "identity_coverage", "read_csv_na", "dup_key_count", "row_rules",
    "missing_profile", "cardinality", "value_counts", "label_corr", "amount_by_class", "amount_percentiles", "histogram",
    "temporal_split", "stratified_sample", "email_risk", "ordinal_encode", "median_table", "feature_table",
    "auroc", "average_precision", "roc_curve", "pr_curve", "gain_curve", "metrics_by_split", "topn_flagging",
    "decile_lift", "threshold_curve", "best_threshold", "top_factors", "mean_abs_contrib", "stump_contrib",
    "iforest_score_fixed", "iforest_nodes", "gbt_scores", "contributions", "score_batch",
    "stream_weekly_rate", "stream_dedup", "stream_score",
)


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    Q.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    for name in HEADLINE:
        if name == "gbt_scores":
            Q.forget_models()  # this one measures training as well, and is warm by its many rounds
        for attempt in ("measured",) if name == "gbt_scores" else ("warm-up", "measured"):
            seconds[name] = round(run(spark, name, folder), 3)
    print(
        json.dumps({
            "metric": "headline queries, total warm seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
            "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        })
    )
    spark.stop()


if __name__ == "__main__":
    main()
