import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import curves as R, profile as P, thresholds as H


@pytest.fixture(scope="module")
def five(spark):
    return spark.createDataFrame([(i, y, s) for i, (y, s) in enumerate(zip([1, 0, 1, 0, 1], [0.9, 0.8, 0.7, 0.3, 0.2]))], "id bigint, y int, score double")


def auroc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def average_precision(y, s):
    total, last = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        hit = (y[s >= t] == 1).sum()
        recall = hit / (y == 1).sum()
        total += (recall - last) * hit / (s >= t).sum()
        last = recall
    return total


def test_small_case(five):
    row = R.ranking_metrics(five, "score", "y").first()
    assert row["auroc"] == 0.5 and row["ap"] == pytest.approx(0.755556, abs=1e-6) and row["ap_random"] == 0.6


def test_ranking_metrics_equal_brute_force(skewed):
    df, frame = skewed
    got = {r["g"]: r for r in R.ranking_metrics(df, "score", "y", ["g"]).collect()}
    for g, part in frame.groupby("g"):
        y, s = part.y.to_numpy(), part.score.to_numpy()
        assert got[g]["auroc"] == pytest.approx(auroc(y, s), abs=1e-12)
        assert got[g]["ap"] == pytest.approx(average_precision(y, s), abs=1e-12)


def test_one_class_has_no_auroc(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, s double")
    row = R.ranking_metrics(df, "s", "y").first()
    assert row["auroc"] is None and row["ap"] == 0.0


def test_roc_keeps_every_bend(skewed):
    df, frame = skewed
    full = R.roc_curve(df, "score", "y", drop_collinear=False).toPandas().sort_values(["fpr", "tpr"])
    short = R.roc_curve(df, "score", "y").toPandas().sort_values(["fpr", "tpr"])
    assert len(full) == frame.score.nunique() + 1 and len(short) < len(full)
    assert np.allclose(np.interp(full.fpr, short.fpr, short.tpr)[full.fpr.diff().fillna(1) > 0], full.tpr[full.fpr.diff().fillna(1) > 0], atol=0.02)
    trapezoid = lambda c: float(((c.fpr.diff() * (c.tpr + c.tpr.shift()) / 2).dropna()).sum())
    expected = auroc(frame.y.to_numpy(), frame.score.to_numpy())
    assert trapezoid(full) == pytest.approx(expected, abs=1e-12)
    assert trapezoid(short) == pytest.approx(expected, abs=1e-12)


def test_pr_curve_is_closed(five):
    rows = {r["threshold"]: (r["precision"], r["recall"]) for r in R.pr_curve(five, "score", "y").collect()}
    assert rows[None] == (1.0, 0.0) and rows[0.9] == (1.0, pytest.approx(1 / 3)) and rows[0.2] == (0.6, 1.0)


def test_confusion_without_positives_reports_true_counts(spark):
    df = spark.createDataFrame([(0, 0.1)] * 4, "y int, s double")
    assert tuple(R.confusion(df, "s", "y", 0.5).first()) == (4, 0, 0, 0)
    assert tuple(R.confusion(df, "s", "y", 0.5).select(*R.precision_recall_f1()).first()) == (0.0, 0.0, 0.0)
    rates = R.confusion_rates(R.confusion(df, "s", "y", 0.5)).first()
    assert (rates["tpr"], rates["fnr"], rates["tnr"], rates["fdr"]) == (0.0, 0.0, 1.0, 0.0)


def test_flagging_includes_ties_at_the_cut(skewed):
    df, frame = skewed
    for row in R.topn_flagging(df, "score", "y").collect():
        cut = np.percentile(frame.score, 100 - row["pct"])
        flagged = frame.score >= cut
        assert row["n_flagged"] == flagged.sum() and row["threshold"] == pytest.approx(cut, abs=1e-12)
        assert row["recall"] == pytest.approx(frame.y[flagged].sum() / frame.y.sum())
        assert row["lift"] == pytest.approx(frame.y[flagged].mean() / frame.y.mean())


def test_deciles_keep_ties_together(skewed):
    import pandas as pd

    df, frame = skewed
    expected = pd.qcut(frame.score, 10, labels=False, duplicates="drop").value_counts().to_dict()
    got = {r["bin"]: r["n_rows"] for r in R.decile_lift(df, "score", "y").collect()}
    assert got == expected and len(got) < 10


def test_score_stats(skewed):
    df, frame = skewed
    got = {r["stat"]: r for r in R.score_stats(df, "score", "y").collect()}
    a, b = frame.score[frame.y == 1], frame.score[frame.y == 0]
    for stat, f in (("mean", np.mean), ("median", np.median), ("std", np.std), ("p10", lambda x: np.percentile(x, 10)), ("p90", lambda x: np.percentile(x, 90))):
        assert got[stat]["positive"] == pytest.approx(f(a)) and got[stat]["negative"] == pytest.approx(f(b))
        assert got[stat]["separation"] == pytest.approx((f(a) - f(b)) / np.std(b))


@pytest.mark.parametrize("grid, count", [(H.SEARCH_GRID, 95), (H.FINE_GRID, 190), (H.COARSE_GRID, 60)])
def test_threshold_grid_equals_a_loop(skewed, grid, count):
    df, frame = skewed
    y, s = frame.y.to_numpy(), frame.score.to_numpy()
    rows = H.threshold_curve(df, "score", "y", grid).orderBy("threshold").collect()
    assert len(rows) == count
    for row, t in zip(rows, np.arange(*grid)):
        assert row["threshold"] == t
        flagged = s >= t
        assert (row["tp"], row["fp"]) == (int((flagged & (y == 1)).sum()), int((flagged & (y == 0)).sum()))
        assert row["tp"] + row["fn"] == y.sum() and row["fp"] + row["tn"] == (1 - y).sum()


def test_first_best_threshold_wins_and_no_rows_fall_back(spark, caplog):
    df = spark.createDataFrame([(1, 0.5), (0, 0.1)], "y int, s double")
    assert H.choose_threshold(df, "s", "y") == (0.11, 1.0)
    assert H.choose_threshold(df.where("y > 5"), "s", "y") == (0.5, None)
    assert "falls back" in caplog.text


def test_best_so_far(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.4), (2, 0.7), (3, 0.6)], "trial int, value double")
    assert [r["best"] for r in H.best_so_far(df, "trial", "value").orderBy("trial").collect()] == [0.5, 0.5, 0.7, 0.7]


def test_histograms_of_many_groups_equal_planned_ones(skewed, monkeypatch):
    df, _ = skewed
    wide = df.withColumn("g", F.when(F.col("id") % 7 > 0, (F.col("id") % 23).cast("string")))
    planned = sorted(map(tuple, P.histogram(wide, "score", 5, ["g"]).collect()), key=repr)
    monkeypatch.setattr(P, "PLANNED_GROUPS", 3)
    joined = sorted(map(tuple, P.histogram(wide, "score", 5, ["g"]).collect()), key=repr)
    assert [(r[0], r[1], r[2]) for r in joined] == [(r[0], r[1], r[2]) for r in planned]
    assert [r[3:] for r in joined] == [pytest.approx(r[3:]) for r in planned]
    within = P.histogram(wide, "score", 5, ["g"], span=(0.2, 0.8)).agg(F.sum("n_rows")).first()[0]
    assert within == wide.where(F.col("score").between(0.2, 0.8)).count()


def test_histogram_counts_every_value_once(skewed):
    df, frame = skewed
    for g, part in frame.groupby("g"):
        rows = [r for r in P.histogram(df, "score", 13, ["g"]).collect() if r["g"] == g]
        counts, edges = np.histogram(part.score, bins=13)
        density, _ = np.histogram(part.score, bins=13, density=True)
        got = np.zeros(13)
        for r in rows:
            got[r["bin"]] = r["n_rows"]
            assert r["density"] == pytest.approx(density[r["bin"]]) and r["left"] == pytest.approx(edges[r["bin"]])
        assert got.sum() == len(part) and np.abs(got - counts).max() <= 1
    flat = P.histogram(df.select(F.lit(2.0).alias("c")), "c", 10).collect()
    assert sum(r["n_rows"] for r in flat) == len(frame)


def test_correlation_of_constant_and_sparse_columns(spark):
    rows = [(float(i), 1.0, float(i * i) if i % 2 else None, i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, "x double, c double, sparse double, y int")
    got = {r["feature"]: r["r"] for r in P.correlations(df, "y", ["x", "c", "sparse"]).collect()}
    x = np.array([r[0] for r in rows]); y = np.array([r[3] for r in rows])
    held = [(r[2], r[3]) for r in rows if r[2] is not None]
    assert got["c"] is None
    assert got["x"] == pytest.approx(np.corrcoef(x, y)[0, 1])
    assert got["sparse"] == pytest.approx(np.corrcoef(*zip(*held))[0, 1])
    assert [r["feature"] for r in P.top_correlations(df, "y", ["x", "c", "sparse"]).collect()] == sorted(
        ["x", "sparse"], key=lambda f: -abs(got[f])
    )


def test_approximate_cardinality_is_one_pass_and_close(merged):
    exact = {r["column"]: r["n_distinct"] for r in P.cardinality(merged).collect()}
    rough = {r["column"]: r["n_distinct"] for r in P.cardinality(merged, approximate=True).collect()}
    assert exact.keys() == rough.keys() and all(abs(exact[c] - rough[c]) <= 1 for c in exact)
