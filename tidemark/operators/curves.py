"""Ranking curves and metrics, exact with ties, grouped by any few-valued columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import scalars as X
from tidemark.operators.ordering import cut_keys, exact_quantiles, ranked_rows, score_ladder

# Review shares of the flagging table and of the gain curve, in percent.
FLAG_PERCENTS = (1, 2, 5, 10, 20)
GAIN_PERCENTS = (1, 2, 5, 10)


# ----------------------------------------------------------------------- curves


def roc_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = (), drop_collinear: bool = True) -> DataFrame:
    """``(by…, threshold, fpr, tpr)`` at each distinct score plus the origin.

    The origin flags nothing and has a NULL threshold. Points on a straight line
    between their neighbours are left out, as they do not change the curve.
    """
    ladder = score_ladder(df, score, label, by)
    if drop_collinear:
        bends = (F.col("pos_next") != F.col("pos")) | (F.col("neg_next") != F.col("neg"))
        ladder = ladder.where(F.col("first") | F.col("pos_next").isNull() | bends)
    point = F.struct(
        F.col("score").alias("threshold"),
        X.safe_divide(F.col("neg_upto"), F.col("neg_all")).alias("fpr"),
        X.safe_divide(F.col("pos_upto"), F.col("pos_all")).alias("tpr"),
    )
    origin = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    points = F.when(F.col("first"), F.array(origin, point)).otherwise(F.array(point))
    return ladder.select(*by, F.explode(points).alias("p")).select(*by, "p.*")


def pr_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by…, threshold, precision, recall)`` at each distinct score, closed at (1, 0)."""
    ladder = score_ladder(df, score, label, by)
    point = F.struct(
        F.col("score").alias("threshold"),
        X.safe_divide(F.col("pos_upto"), F.col("pos_upto") + F.col("neg_upto")).alias("precision"),
        X.safe_divide(F.col("pos_upto"), F.col("pos_all"), 1.0).alias("recall"),
    )
    close = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    points = F.when(F.col("first"), F.array(close, point)).otherwise(F.array(point))
    return ladder.select(*by, F.explode(points).alias("p")).select(*by, "p.*")


def gain_curve(df: DataFrame, score: str, key: str, label: str) -> DataFrame:
    """Share of positives found by reviewing the highest scores first, row by row."""
    ranked = ranked_rows(df, score, key, label)
    return ranked.select(
        "key", "rank",
        (F.col("rank") / F.col("rows_all")).alias("share_flagged"),
        X.ratio(F.col("pos_upto"), F.col("pos_all")).alias("capture"),
        "rows_all",
    )


def gain_marks(df: DataFrame, score: str, key: str, label: str, percents: Sequence[int] = GAIN_PERCENTS) -> DataFrame:
    """Capture after reviewing the top ``pct`` percent of the rows.

    The cut of every mark is found by its key, and one pass counts the positives before
    each: no row is ranked or shuffled.
    """
    value = F.col(score).cast("double")
    rows = df.where(value.isNotNull() & ~F.isnan(value)).select((-value).alias("_down"), F.col(key).alias("_key"), F.col(label).alias("_y"))

    def ranks(n: int) -> list[int]:
        return [max(n * p // 100, 1) for p in percents]

    cuts, n = cut_keys(rows.select("_down", "_key"), "_down", "_key", [p / 100 for p in percents], ranks)
    counts = rows.agg(
        F.sum("_y").alias("all"),
        *[F.sum(F.when(cut.before("_down", "_key"), F.col("_y"))).alias(f"p{i}") for i, cut in enumerate(cuts)],
    )
    marks = [
        F.struct(F.lit(p).alias("pct"), F.lit(rank).cast("bigint").alias("rank"), F.lit(rank / n).alias("share_flagged"),
                 X.ratio(F.col(f"p{i}"), F.col("all")).alias("capture"))
        for i, (p, rank) in enumerate(zip(percents, ranks(n) if n else []))
    ]
    empty = df.sparkSession.createDataFrame([], "pct int, rank bigint, share_flagged double, capture double")
    return counts.select(F.inline(F.array(*marks))) if marks else empty


# ---------------------------------------------------------------------- ranking metrics


def _ladder_metrics() -> list[Column]:
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    below = (F.col("neg_all") - F.col("neg_upto")).cast("double")
    pairs = F.max(F.col("pos_all").cast("double") * F.col("neg_all").cast("double"))
    won = F.sum(pos * below + F.lit(0.5) * pos * neg)
    precision = F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto"))
    return [
        (won / F.when(pairs > 0, pairs)).alias("auroc"),
        X.safe_divide(F.sum(pos * precision), F.max("pos_all")).alias("ap"),
        F.max("pos_all").alias("n_positive"),
        F.max("neg_all").alias("n_negative"),
    ]


def ranking_metrics(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """AUROC (ties count half; NULL with one class) and average precision, with their random baselines."""
    rows = score_ladder(df, score, label, by).groupBy(*by).agg(*_ladder_metrics())
    rate = F.col("n_positive") / F.greatest(F.col("n_positive") + F.col("n_negative"), F.lit(1))
    return rows.select(
        *by, "auroc", "ap", "n_positive", "n_negative", F.lit(0.5).alias("auroc_random"), rate.alias("ap_random")
    )


def confusion(df: DataFrame, score: str, label: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """True counts ``tn, fp, fn, tp`` at a threshold, also when a class is absent."""
    flagged, positive = X.decide(F.col(score), threshold), F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count_if(~flagged & ~positive).alias("tn"), F.count_if(flagged & ~positive).alias("fp"),
        F.count_if(~flagged & positive).alias("fn"), F.count_if(flagged & positive).alias("tp"),
    )


def precision_recall_f1() -> list[Column]:
    """Columns over ``fp, fn, tp``; 0 where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return [
        X.safe_divide(tp, tp + fp).alias("precision"),
        X.safe_divide(tp, tp + fn).alias("recall"),
        X.safe_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def confusion_rates(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """TPR, FNR, FPR, TNR, FDR of a confusion row; the first four are its row-normalised matrix."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.select(
        *by, "tn", "fp", "fn", "tp",
        X.ratio(tp, tp + fn).alias("tpr"), X.ratio(fn, tp + fn).alias("fnr"),
        X.ratio(fp, tn + fp).alias("fpr"), X.ratio(tn, tn + fp).alias("tnr"),
        X.ratio(fp, tp + fp).alias("fdr"),
    )


def review_queue(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What reviewing the flagged rows means: queue size, caught, missed, wrongly flagged."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    return counts.select(
        *by, total.alias("n_rows"), (tp + fn).alias("n_positive"), (tp + fp).alias("n_flagged"),
        (X.ratio(tp + fp, total) * 100).alias("pct_flagged"),
        tp.alias("n_caught"), fn.alias("n_missed"), fp.alias("n_wrongly_flagged"),
    )


def metrics_by_group(df: DataFrame, score: str, label: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """Ranking and threshold metrics of every group from one set of prefix sums."""
    flagged = X.decide(F.col("score"), threshold)
    rows = score_ladder(df, score, label, by).groupBy(*by).agg(
        *_ladder_metrics(),
        F.coalesce(F.sum(F.when(flagged, F.col("pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(flagged, F.col("neg"))), F.lit(0)).alias("fp"),
    )
    rows = rows.select(
        "*", (F.col("n_positive") - F.col("tp")).alias("fn"), (F.col("n_negative") - F.col("fp")).alias("tn")
    )
    rate = F.col("n_positive") / F.greatest(F.col("n_positive") + F.col("n_negative"), F.lit(1))
    return rows.select(
        *by, "auroc", "ap", *precision_recall_f1(), F.lit(float(threshold)).alias("threshold"),
        "tn", "fp", "fn", "tp", F.lit(0.5).alias("auroc_random"), rate.alias("ap_random"),
    )


def operating_point(df: DataFrame, score: str, label: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """Where a threshold lies on the ROC and precision-recall curves."""
    counts = confusion(df, score, label, threshold, by)
    return confusion_rates(counts, by).select(
        *by, F.lit(float(threshold)).alias("threshold"), "fpr", "tpr", *precision_recall_f1()
    )


# ---------------------------------------------------------------------- flagging and bins


def _group_cuts(df: DataFrame, score: str, probs: Sequence[float], by: Sequence[str]) -> list[Column]:
    """Exact cut per probability as an expression over the group columns.

    One row per group is brought to the driver; groups are splits or classes.
    """
    rows = exact_quantiles(df, [score], probs, by).collect()
    cuts = []
    for i in range(len(probs)):
        cut = F.lit(None).cast("double")
        for row in rows:
            here = F.lit(True)
            for c in by:
                here = here & F.col(c).eqNullSafe(F.lit(row[c]))
            cut = F.when(here, F.lit(row[f"q{i}"])).otherwise(cut)
        cuts.append(cut)
    return cuts


def topn_flagging(
    df: DataFrame, score: str, label: str, by: Sequence[str] = (), percents: Sequence[int] = FLAG_PERCENTS
) -> DataFrame:
    """Flag scores at or above the (100 - pct) percentile; recall, precision, F1, lift."""
    df = df.where(F.col(label).isNotNull())
    cuts = _group_cuts(df, score, [1 - p / 100 for p in percents], by)
    positive = F.col(label) == 1
    aggs = [F.count(score).alias("n"), F.count_if(positive & F.col(score).isNotNull()).alias("p")]
    for i, cut in enumerate(cuts):
        flagged = F.col(score) >= cut
        aggs += [
            F.max(cut).alias(f"t{i}"), F.count_if(flagged).alias(f"f{i}"), F.count_if(flagged & positive).alias(f"h{i}")
        ]
    wide = df.groupBy(*by).agg(*aggs)
    entries = [
        F.struct(
            F.lit(pct).alias("pct"), F.col(f"t{i}").alias("threshold"),
            F.col(f"f{i}").alias("n_flagged"), F.col(f"h{i}").alias("n_hits"),
        )
        for i, pct in enumerate(percents)
    ]
    rows = wide.select(*by, "n", "p", F.explode(F.array(*entries)).alias("e")).select(*by, "n", "p", "e.*")
    recall = X.ratio(F.col("n_hits"), F.col("p"))
    precision = X.safe_divide(F.col("n_hits"), F.col("n_flagged"))
    base = X.safe_divide(F.col("p"), F.col("n"))
    return rows.select(
        *by, "pct", "threshold", "n_flagged", recall.alias("recall"), precision.alias("precision"),
        X.safe_divide(2 * precision * recall, precision + recall).alias("f1"),
        X.ratio(precision, base, 1e-9).alias("lift"),
    )


def signal_report(df: DataFrame, score: str, label: str, by: Sequence[str]) -> DataFrame:
    """Ranking metrics of each group beside its flagging table."""
    ranking = ranking_metrics(df, score, label, by).select(*by, "auroc", "ap")
    return topn_flagging(df, score, label, by).join(ranking, list(by))


def quantile_edges(df: DataFrame, score: str, bins: int = 10) -> list[float]:
    """Distinct edges of equal-frequency bins: ``bins + 1`` numbers at most."""
    row = exact_quantiles(df, [score], [i / bins for i in range(bins + 1)]).first()
    return sorted({row[f"q{i}"] for i in range(bins + 1)}) if row else []


def quantile_bin(score: Column, edges: Sequence[float]) -> Column:
    """Right-closed bin of a score; equal scores share a bin, the lowest is included."""
    index = F.lit(0)
    for edge in edges[1:-1]:
        index = index + (score > F.lit(float(edge))).cast("int")
    return index


def decile_lift(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Positive rate and lift per equal-frequency bin, and how it compares to the overall rate."""
    edges = quantile_edges(df, score, bins)
    rows = df.where(F.col(score).isNotNull())
    per_bin = rows.groupBy(quantile_bin(F.col(score), edges).alias("bin")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(label).cast("long")).alias("n_positive")
    )
    base = rows.agg(F.avg(F.col(label).cast("double")).alias("base")).select("base").scalar()
    return per_bin.select(
        "bin", "n_rows", (F.col("n_positive") / F.col("n_rows")).alias("rate"), base.alias("base")
    ).select(
        "bin", "n_rows", "rate",
        X.ratio(F.col("rate"), F.col("base"), 1e-9).alias("lift"),
        X.lift_band(F.col("rate"), F.col("base")).alias("band"),
    )


def score_stats(df: DataFrame, score: str, label: str) -> DataFrame:
    """Mean, median, population std, p10 and p90 per class, and how far apart the classes are."""
    x = F.col(score).cast("double")
    moments = df.groupBy(label).agg(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"))
    quantiles = exact_quantiles(df, [score], [0.5, 0.1, 0.9], [label])
    # Two rows on both sides.
    stats = moments.join(quantiles, label).select(
        label, "std",
        F.explode(F.array(*[
            F.struct(F.lit(name).alias("stat"), F.col(source).alias("value"))
            for name, source in (("mean", "mean"), ("median", "q0"), ("std", "std"), ("p10", "q1"), ("p90", "q2"))
        ])).alias("s"),
    )
    pivoted = stats.groupBy("s.stat").agg(
        F.max(F.when(F.col(label) == 1, F.col("s.value"))).alias("positive"),
        F.max(F.when(F.col(label) == 0, F.col("s.value"))).alias("negative"),
        F.max(F.when(F.col(label) == 0, F.col("std"))).alias("_spread"),
    )
    return pivoted.select(
        "stat", "positive", "negative",
        X.ratio(F.col("positive") - F.col("negative"), F.col("_spread"), 1e-9).alias("separation"),
    )


def score_range(df: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.min(score).alias("score_min"), F.max(score).alias("score_max"))


def true_positives(df: DataFrame, score: str, label: str, threshold: float, key: str, top: int = 5) -> DataFrame:
    """The most confident correct flags: the report shows ``top`` of them."""
    caught = df.where(X.decide(F.col(score), threshold) & (F.col(label) == 1))
    return caught.orderBy(F.col(score).desc(), F.col(key).asc()).limit(top)
