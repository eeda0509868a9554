import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.ordering import cut_keys, exact_quantiles, ranked_rows, score_ladder

PROBS = [0.0, 0.01, 0.1, 0.25, 0.5, 0.77, 0.9, 0.99, 1.0]


@pytest.mark.parametrize("accuracy, limit", [(1_000, 10**6), (20, 60)])
def test_quantiles_equal_numpy_also_when_brackets_are_narrowed(skewed, accuracy, limit):
    df, frame = skewed
    rows = exact_quantiles(df, ["score", "dt"], PROBS, accuracy=accuracy, limit=limit).collect()
    assert {r["feature"] for r in rows} == {"score", "dt"}
    for row in rows:
        expected = np.percentile(frame[row["feature"]].astype(float), [100 * p for p in PROBS])
        assert np.allclose([row[f"q{i}"] for i in range(len(PROBS))], expected, rtol=0, atol=1e-12)
        assert row["n"] == len(frame)


def test_quantiles_per_group_and_with_missing_values(spark):
    rng = np.random.default_rng(0)
    values = [(g, float(v) if rng.random() > 0.3 else None) for g in "abc" for v in rng.normal(size=37)]
    values += [("empty", None), ("nan", float("nan")), ("one", 4.0)]
    df = spark.createDataFrame(values, "g string, v double")
    got = {r["g"]: (r["n"], r["q0"]) for r in exact_quantiles(df, ["v"], [0.5], ["g"]).collect()}
    for g in "abc":
        held = [v for k, v in values if k == g and v is not None]
        assert got[g] == (len(held), pytest.approx(float(np.median(held)), abs=1e-12))
    assert got["one"] == (1, 4.0)
    assert "empty" not in got and "nan" not in got


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 11, 100])
def test_quantiles_of_small_groups(spark, n):
    values = np.random.default_rng(n).permutation(n).astype(float)
    row = exact_quantiles(spark.createDataFrame([(float(v),) for v in values], "v double"), ["v"], PROBS).first()
    assert np.allclose([row[f"q{i}"] for i in range(len(PROBS))], np.percentile(values, [100 * p for p in PROBS]))


def test_a_column_without_values_has_no_row(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, ["v"], [0.5]).collect() == []


@pytest.mark.parametrize("accuracy, limit", [(1_000, 10**6), (20, 60)])
def test_cut_keys_split_exactly_inside_long_ties(skewed, accuracy, limit):
    df, frame = skewed
    n = len(frame)
    order = frame.sort_values(["dt", "id"]).reset_index(drop=True)
    places = [0, 1, n // 4, n // 3, n // 2, n - 1, n]
    keys, count = cut_keys(df, "dt", "id", [p / n for p in places], lambda _: places, accuracy, limit)
    assert count == n
    for place, key in zip(places, keys):
        before = df.where(key.before("dt", "id"))
        assert before.count() == place
        assert df.where(key.not_before("dt", "id")).count() == n - place
        if 0 < place < n:
            last = before.orderBy(F.col("dt").desc(), F.col("id").desc()).first()
            assert (last["dt"], last["id"]) == (order.dt[place - 1], order.id[place - 1])


def test_ladder_equals_brute_force_per_group(skewed):
    df, frame = skewed
    got = score_ladder(df, "score", "y", ["g"], buckets=12).toPandas()
    for g, part in frame.groupby("g"):
        expected = part.groupby("score").y.agg(pos="sum", n="count").sort_index(ascending=False)
        mine = got[got.g == g].sort_values("score", ascending=False)
        assert (mine.score.values == expected.index.values).all()
        assert (mine.pos.values == expected.pos.values).all()
        assert (mine.pos_upto.values == expected.pos.cumsum().values).all()
        assert (mine.neg_upto.values == (expected.n - expected.pos).cumsum().values).all()
        assert (mine.pos_next.values[:-1] == expected.pos.values[1:]).all() and np.isnan(mine.pos_next.values[-1])
        assert mine["first"].tolist() == [True] + [False] * (len(mine) - 1)
        assert set(mine.pos_all) == {part.y.sum()}


def test_ladder_with_a_missing_group_and_missing_scores(spark):
    df = spark.createDataFrame([(None, 0.5, 1), (None, 0.4, 0), ("a", None, 1), ("a", 0.1, 1)], "g string, s double, y int")
    rows = score_ladder(df, "s", "y", ["g"]).collect()
    assert sorted((r["g"] or "", r["score"], r["pos_upto"], r["neg_upto"]) for r in rows) == [
        ("", 0.4, 1, 1), ("", 0.5, 1, 0), ("a", 0.1, 1, 0)
    ]


def test_ranks_are_a_total_order_and_hot_scores_are_divided(skewed):
    df, frame = skewed
    ranked = ranked_rows(df, "score", "id", "y", buckets=16)
    got = ranked.toPandas().sort_values("rank")
    expected = frame.sort_values(["score", "id"], ascending=[False, True])
    assert got["rank"].tolist() == list(range(1, len(frame) + 1))
    assert (got.key.values == expected.id.values).all()
    assert (got.pos_upto.values == expected.y.cumsum().values).all()


def _windows(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan


def test_row_level_windows_are_partitioned_and_nothing_is_crossed(skewed):
    df, _ = skewed
    for frame in (score_ladder(df, "score", "y"), ranked_rows(df, "score", "id", "y")):
        plan = _windows(frame)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        # The only single-task windows run over one row per bucket.
        for line in plan.splitlines():
            if line.strip().lstrip("+-:* ").startswith("Window") and "score" in line:
                assert "[_bucket" in line


@pytest.mark.parametrize("kind", ["string", "date", "timestamp"])
def test_ranks_of_tied_rows_follow_keys_of_any_type(spark, kind):
    """Two thirds share a score, so that their bucket is divided by key ranges."""
    text = {"string": "concat('k', lpad(cast(id * 7 % 600 as string), 9, '0'))", "date": "date_add(date'2020-01-01', cast(id * 7 % 600 as int))",
            "timestamp": "timestamp_seconds(id * 7 % 600 * 5000)"}[kind]
    rows = spark.range(600).selectExpr(f"{text} AS k", "CASE WHEN id % 3 > 0 THEN 0.5D ELSE id / 600D END AS s", "CAST(id % 5 = 0 AS INT) AS y")
    got = ranked_rows(rows, "s", "k", "y", buckets=12).orderBy("rank").collect()
    expected = sorted(rows.collect(), key=lambda r: (-r["s"], r["k"]))
    assert [(r["key"], r["rank"]) for r in got] == [(r["k"], i + 1) for i, r in enumerate(expected)]
    assert got[-1]["pos_upto"] == sum(r["y"] for r in expected)
