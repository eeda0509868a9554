import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.operators import boosting as B, contributions as C, curves as R, isolation as I
from tidemark.session import fresh_path

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    n = 1_500
    frame = pd.DataFrame(rng.normal(size=(n, 3)), columns=COLUMNS)
    frame["c"] = np.where(rng.random(n) < 0.4, 0.0, frame["c"])
    frame.loc[:14, "a"] = 9.0
    odds = 2 * frame["a"].clip(-2, 2) - frame["b"] * (frame["c"] > 0) - 2
    frame[S.LABEL] = (rng.random(n) < 1 / (1 + np.exp(-odds))).astype("int32")
    frame[S.KEY] = np.arange(n)
    frame[S.SPLIT] = np.where(np.arange(n) < 1000, "train", np.where(np.arange(n) < 1250, "val", "test"))
    df = spark.createDataFrame(frame).repartition(3).cache()
    df.count()
    return df, frame


# ------------------------------------------------------------------------------ forest


def test_average_path():
    harmonic = lambda n: 2 * (math.log(n - 1) + I.EULER_GAMMA) - 2 * (n - 1) / n
    assert I.average_path([0, 1, 2, 3, 256]).tolist() == pytest.approx([0, 0, 1, harmonic(3), harmonic(256)])


@pytest.mark.parametrize("sample", [64, 1_500, 5_000])
def test_samples_are_exact_and_distinct(rows, sample):
    df, frame = rows
    got = I.tree_samples(df, S.KEY, COLUMNS, 20, sample, 42, len(frame)).toPandas()
    sizes = got.groupby("tree").size()
    assert len(sizes) == 20 and set(sizes) == {min(sample, len(frame))}
    assert not got.duplicated(["tree", S.KEY]).any()
    values = frame.set_index(S.KEY)[COLUMNS]
    assert all(values.loc[k].tolist() == list(v) for k, v in zip(got[S.KEY][:200], got["values"][:200]))
    again = I.tree_samples(df.repartition(7), S.KEY, COLUMNS, 20, sample, 42, len(frame)).toPandas()
    assert set(zip(got.tree, got[S.KEY])) == set(zip(again.tree, again[S.KEY]))


def test_short_draws_read_more_buckets(rows, monkeypatch):
    df, frame = rows
    asked = []
    real = I.tickets
    monkeypatch.setattr(I, "tickets", lambda spark, trees, per_tree, buckets, seed: asked.append(per_tree) or real(spark, trees, 1 if len(asked) == 1 else per_tree, buckets, seed))
    got = I.tree_samples(df, S.KEY, COLUMNS, 20, 64, 42, len(frame)).toPandas()
    assert len(asked) == 2 and asked[1] == 2 * asked[0] and set(got.groupby("tree").size()) == {64}


def test_every_row_is_drawn_alike(spark):
    """No key is favoured: over many trees, draws per row are as spread as chance has it."""
    big = spark.range(4_000).select(F.col("id").alias(S.KEY), F.lit(1.0).alias("x"))
    counts = I.tree_samples(big, S.KEY, ["x"], 500, 64, 1, 4_000).groupBy(S.KEY).count()
    drawn = {r[0]: r[1] for r in counts.collect()}
    spread = np.array([drawn.get(i, 0) for i in range(4_000)])
    assert spread.sum() == 500 * 64 and spread.var() < 2 * spread.mean() and (spread == 0).mean() < 0.01


def test_drawn_samples_match_the_expected_size_on_a_larger_table(spark):
    big = spark.range(30_000).select(F.col("id").alias(S.KEY), (F.col("id") % 997).cast("double").alias("x"))
    got = I.tree_samples(big, S.KEY, ["x"], 50, 64, 1, 30_000)
    assert {r[1] for r in got.groupBy("tree").count().collect()} == {64}
    assert got.select("tree").distinct().count() == 50


def path_length(nodes, row, tree):
    table = nodes[nodes.tree == tree].set_index("node")
    at = table.loc[0]
    while at.feature >= 0:
        at = table.loc[at.left if row[int(at.feature)] <= at.threshold else at.right]
    return at.depth + float(I.average_path(at["size"]))


def test_forest_scores_equal_walking_the_node_table(rows):
    df, frame = rows
    model = I.AnomalyForest(inputCols=[*COLUMNS, S.SCORE], trees=15, sampleSize=64, contamination=0.05).fit(df)
    assert model.learned("columns") == COLUMNS
    nodes = model.table.toPandas()
    assert nodes.tree.nunique() == 15 and nodes.depth.max() <= 6
    for _, tree in nodes.groupby("tree"):
        assert tree[tree.feature < 0]["size"].sum() == 64 and tree["size"].max() == 64
    scored = model.transform(df).toPandas()
    part = scored.head(40)
    for _, row in part.iterrows():
        values = row[COLUMNS].to_numpy(dtype=float)
        mean = np.mean([path_length(nodes, values, t) for t in range(15)])
        expected = 2 ** (-mean / float(I.average_path(64))) + model.learned("offset")
        assert row[S.SCORE] == pytest.approx(expected, abs=1e-12)
    # Zero is the contamination cut, and the planted outliers are beyond it.
    assert (scored[S.SCORE] > 0).mean() == pytest.approx(0.05, abs=0.01)
    assert (scored[scored.a == 9.0][S.SCORE] > 0).all()


def test_forest_is_repeatable_and_survives_saving(spark, rows):
    df, _ = rows
    fit = lambda frame: I.AnomalyForest(inputCols=COLUMNS, trees=5, sampleSize=32).fit(frame)
    one, two = fit(df), fit(df.repartition(9))
    assert one.table.exceptAll(two.table).count() == 0
    path = fresh_path(spark, "forest")
    one.save(path)
    loaded = I.AnomalyForestModel.load(path)
    assert loaded.transform(df).exceptAll(one.transform(df)).count() == 0


# ------------------------------------------------------------------------------- trees


@pytest.fixture(scope="module")
def boosted(rows):
    df, _ = rows
    params = B.BoostParams(max_depth=3, min_rows_per_leaf=5)
    return B.fit_boosted(df.where("split = 'train'"), df.where("split = 'val'"), COLUMNS, params, max_rounds=8, patience=4)


def test_probabilities_equal_the_library_model(rows):
    df, _ = rows
    vectors = VectorAssembler(inputCols=COLUMNS, outputCol="_features").transform(df).select(
        "*", F.col(S.LABEL).cast("double").alias("label"), F.lit(1.0).alias("_weight")
    )
    model = B._classifier(B.BoostParams(max_depth=3), 4, "label").fit(vectors)
    trees = B.ensemble_of(model, COLUMNS)
    both = B.predict(model.transform(vectors), trees, "ours").withColumn("theirs", vector_to_array("probability")[1])
    assert both.select(F.max(F.abs(F.col("ours") - F.col("theirs")))).first()[0] < 1e-12
    shares = {r["feature"]: r["importance"] for r in B.importance(trees, df.sparkSession).collect()}
    assert sum(shares.values()) == pytest.approx(1.0) and max(shares, key=shares.get) == "a"


def test_best_round_is_kept(rows, boosted):
    df, _ = rows
    values = dict(boosted.log)
    assert boosted.rounds == B.stop_round(boosted.log, 4) == boosted.nodes.tree.nunique()
    last = B.staged_auroc(df.where("split = 'val'"), boosted, S.LABEL)
    assert last[-1] == (boosted.rounds, pytest.approx(values[boosted.rounds], abs=1e-12))


def test_a_longer_fit_repeats_the_earlier_trees(rows):
    df, _ = rows
    train, held = df.where("split = 'train'"), df.where("split = 'val'")
    params = B.BoostParams(max_depth=3, min_rows_per_leaf=5, row_share=0.7, feature_share=0.7)
    fit = lambda n: B.fit_boosted(train, held, COLUMNS, params, max_rounds=n, patience=n, first_rounds=n)
    short, long = fit(3), fit(6)
    assert [v for _, v in long.log[:3]] == pytest.approx([v for _, v in short.log], abs=1e-12)


def test_rounds_are_ranked_in_parts_with_the_same_result(rows, boosted, monkeypatch):
    df, _ = rows
    held = df.where("split = 'val'")
    whole = B.staged_auroc(held, boosted, S.LABEL)
    monkeypatch.setattr(B, "STAGES_PER_JOB", 2)
    assert B.staged_auroc(held, boosted, S.LABEL) == whole
    assert B.staged_auroc(held, boosted, S.LABEL, after=1) == whole[1:]


def test_patience():
    assert B.stop_round([(1, 0.5), (2, 0.7), (3, 0.6), (4, 0.6), (5, 0.9)], patience=2) == 2
    assert B.stop_round([(1, 0.5), (2, 0.7), (3, 0.6), (4, 0.9)], patience=2) == 4
    assert B.stop_round([(1, None), (2, 0.2)], patience=5) == 2


def test_rounds_double_until_patience_is_spent(rows, monkeypatch):
    df, _ = rows
    asked = []

    class Fit:
        def __init__(self, rounds):
            self.rounds = rounds

        def fit(self, _):
            asked.append(self.rounds)
            return self

    values = [0.5 + 0.01 * min(i, 9) for i in range(1, 100)]
    monkeypatch.setattr(B, "_classifier", lambda params, rounds, label: Fit(rounds))
    monkeypatch.setattr(B, "ensemble_of", lambda m, f: B.Ensemble(list(f), pd.DataFrame({"tree": range(m.rounds)}), m.rounds))
    monkeypatch.setattr(B, "staged_auroc", lambda d, e, l, after: [(i + 1, values[i]) for i in range(after, e.rounds)])
    fitted = B.fit_boosted(df, df, COLUMNS, max_rounds=100, patience=3, weight=1.0)
    assert asked == [6, 12] and fitted.rounds == 9


def brute_force_terms(nodes, values):
    """Shapley values of the cover-weighted tree expectation, by enumeration."""
    def expectation(table, node, known):
        at = table.loc[node]
        if at.feature < 0:
            return at.value
        if int(at.feature) in known:
            return expectation(table, at.left if values[int(at.feature)] <= at.threshold else at.right, known)
        weight = table.loc[at.left].cover / at.cover
        return weight * expectation(table, at.left, known) + (1 - weight) * expectation(table, at.right, known)

    terms, m = np.zeros(len(values)), len(values)
    for _, tree in nodes.groupby("tree"):
        table = tree.set_index("node")
        for j in range(m):
            others = [i for i in range(m) if i != j]
            for size in range(m):
                for chosen in itertools.combinations(others, size):
                    weight = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
                    terms[j] += weight * (expectation(table, 0, {*chosen, j}) - expectation(table, 0, set(chosen)))
    return terms


def test_contributions_equal_enumerated_shapley_values(spark, rows, boosted):
    df, frame = rows
    explainer = C.Explainer(boosted)
    values = frame[COLUMNS].to_numpy()[:25]
    got = explainer.explain(values)
    for row, terms in zip(values, got):
        assert terms == pytest.approx(brute_force_terms(boosted.nodes, row), abs=1e-12)
    explainer.keep_tables = False
    assert np.array_equal(explainer.explain(values), got)


def test_contributions_add_up_to_the_log_odds(spark, rows, boosted):
    df, _ = rows
    terms, base = C.contributions_column(spark, boosted)
    total = F.aggregate(terms, F.lit(base), lambda acc, c: acc + c)
    gap = df.select(F.abs(total - B.log_odds_column(spark, boosted)).alias("d")).agg(F.max("d")).first()[0]
    assert gap < 1e-10


def test_ensemble_survives_saving(spark, rows, boosted):
    path = fresh_path(spark, "trees")
    boosted.save(spark, path)
    loaded = B.Ensemble.load(spark, path)
    assert loaded.features == boosted.features and loaded.rounds == boosted.rounds
    assert B.predict(rows[0], loaded).exceptAll(B.predict(rows[0], boosted)).count() == 0


def test_search_reports_trials_and_the_best(rows):
    df, _ = rows
    log, best = B.search_params(
        df.where("split = 'train'"), df.where("split = 'val'"), COLUMNS, trials=3, max_rounds=2, patience=2, sample_fraction=0.5
    )
    got = log.orderBy("trial").collect()
    assert [r["trial"] for r in got] == [0, 1, 2]
    winner = max(got, key=lambda r: (r["value"], -r["trial"]))
    assert winner["params"]["step_size"] == best.step_size
    for params in B.draw_trials(200):
        for name, (low, high) in B.SEARCH_SPACE.items():
            assert low <= getattr(params, name) <= high


def test_class_weight(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "isFraud int")
    assert tuple(B.positive_class_weight(df).first()) == (1, 3, 3.0)
    assert B.positive_class_weight(df.where("isFraud = 0")).first()["weight"] == 3.0


# --------------------------------------------------------------- contribution tables


@pytest.fixture(scope="module")
def explained(spark):
    return spark.createDataFrame(
        [(1, [0.5, -0.9, 0.1, 0.0], [1.0, float("nan"), 3.0, 4.0], 0.3), (2, [0.0, 0.0, 0.0, 0.0], [1.0, 2.0, 3.0, 4.0], 1.0)],
        "TransactionID bigint, terms array<double>, vals array<double>, p double",
    )


def test_top_factors(explained):
    got = C.top_factors(explained, S.KEY, "terms", "vals", list("wxyz")).orderBy(S.KEY, "rank").collect()
    assert [tuple(r) for r in got[:3]] == [
        (1, 1, "x", -0.9, None, "decreases_risk"), (1, 2, "w", 0.5, 1.0, "increases_risk"), (1, 3, "y", 0.1, 3.0, "increases_risk"),
    ]
    assert [r["feature"] for r in got[3:]] == ["w", "x", "y"] and {r["direction"] for r in got[3:]} == {"decreases_risk"}


def test_waterfall_steps_add_up(explained):
    factors = C.factor_column(F.col("terms"), F.col("vals"), list("wxyz"))
    rows = C.waterfall_rows(explained.withColumn("f", factors), S.KEY, "p", "f").orderBy(S.KEY, "step").collect()
    first = [r for r in rows if r[S.KEY] == 1]
    assert [r["measure"] for r in first] == ["absolute"] + ["relative"] * 4 + ["total"]
    assert sum(r["value"] for r in first[:-1]) == pytest.approx(first[-1]["value"]) == pytest.approx(math.log(0.3 / 0.7))


def test_case_terms_keep_the_whole_sum(explained):
    rows = C.case_terms(explained, S.KEY, list("wxyz"), "terms", "vals", shown=3).collect()
    first = [r for r in rows if r[S.KEY] == 1]
    assert [r["feature"] for r in first] == ["x", "w", "other"]
    assert sum(r["contribution"] for r in first) == pytest.approx(-0.3)
    assert len(C.case_terms(explained, S.KEY, list("wxyz"), "terms", "vals").collect()) == 8


def test_mean_abs(explained):
    got = {r["feature"]: r["mean_abs"] for r in C.mean_abs_contributions(explained, list("wxyz"), "terms").collect()}
    assert got == {"w": 0.25, "x": 0.45, "y": 0.05, "z": 0.0}


def test_rounds_ranked_by_ranges_of_scores_equal_the_ladder(spark, rows, boosted, monkeypatch):
    df, _ = rows
    # A third of the rows are copies of one, so that scores are tied within ranges.
    held = df.where("split = 'val'")
    held = held.unionByName(held.limit(1).withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(60)))).drop("_n"))
    monkeypatch.setattr(B, "RANKED_ROWS", 20)
    got = dict(B.staged_auroc(held, boosted, S.LABEL))
    for n in (1, boosted.rounds):
        scored = held.withColumn("s", B.log_odds_column(spark, boosted.first(n)))
        assert got[n] == pytest.approx(R.ranking_metrics(scored, "s", S.LABEL).first()["auroc"], abs=1e-12)


def test_terms_of_many_rows_are_those_of_each_row(boosted, rows, monkeypatch):
    _, frame = rows
    explainer, values = C.Explainer(boosted), frame[COLUMNS].to_numpy()
    values = np.where(np.random.default_rng(3).random(values.shape) < 0.1, np.nan, values)
    one_by_one = np.vstack([explainer.explain(values[i : i + 1]) for i in range(50)])
    solved = []
    terms = C._Leaf.terms
    monkeypatch.setattr(C._Leaf, "terms", lambda leaf, holds: solved.append(len(holds)) or terms(leaf, holds))
    assert np.allclose(explainer.explain(values)[:50], one_by_one, rtol=0, atol=1e-14)
    assert max(solved) <= 1 << len(COLUMNS)  # combinations of conditions, not rows


@pytest.mark.parametrize("limit", [I.WHOLE_DEPTH, 0])
def test_whole_levels_give_the_paths_of_single_steps(limit, monkeypatch):
    rng = np.random.default_rng(11)
    nodes = pd.concat([I.grow_tree(rng.normal(size=(size, 3)).round(1), t, 4) for t, size in enumerate((1, 2, 40, 256))])
    monkeypatch.setattr(I, "WHOLE_DEPTH", limit)
    forest = I._Forest(nodes, 256)
    values = rng.normal(size=(60, 3))
    values[rng.random(values.shape) < 0.2] = np.nan
    wanted = []
    for row in values:
        total = 0.0
        for _, tree in nodes.groupby("tree"):
            node = tree.iloc[0]
            while node.feature >= 0:
                node = tree.iloc[int(node.left if row[int(node.feature)] <= node.threshold else node.right)]
            total += node.depth + float(I.average_path(node["size"]))
        wanted.append(2.0 ** (-total / 4 / float(I.average_path(256))))
    assert (forest.whole[-1] is None) == (limit == 0)
    assert forest.isolation(values) == pytest.approx(wanted, abs=1e-12)


def test_tables_of_terms_equal_the_leaves_one_by_one():
    rng = np.random.default_rng(12)
    rows = []

    def grow(tree, depth, cover):
        at = len(rows)
        rows.append([tree, at - start, -1, 0.0, -1, -1, float(rng.normal()), cover, 0.0, 0])
        if depth and cover > 2 and rng.random() < 0.95:
            left = max(1.0, round(cover * rng.uniform(0.2, 0.8)))
            rows[at][2:4] = [int(rng.integers(4)), float(rng.normal())]
            rows[at][9] = int(rng.integers(2))
            rows[at][4] = grow(tree, depth - 1, left)
            rows[at][5] = grow(tree, depth - 1, cover - left)
        return at - start

    for tree, depth in enumerate((0, 2, 4, 11)):
        start = len(rows)
        grow(tree, depth, 400.0)
    names = "tree node feature threshold left right value cover gain missing".split()
    explainer = C.Explainer(B.Ensemble(list("abcd"), pd.DataFrame(rows, columns=names), 4))
    values = rng.normal(size=(400, 4))
    values[rng.random(values.shape) < 0.2] = np.nan
    assert any(len(nodes) > C.TABLE_BITS for nodes, _ in explainer.parts)
    terms = np.zeros((4, 400))
    for leaf in explainer.leaves:
        leaf.add_terms(values.T, np.isnan(values.T), terms)
    assert explainer.tables is None
    assert np.allclose(explainer.explain(values), terms.T, rtol=0, atol=1e-12) and explainer.tables
    scores = B.TreeArrays(pd.DataFrame(rows, columns=names)).tree_terms(values).sum(axis=1)
    assert np.allclose(explainer.explain(values).sum(axis=1) + explainer.expected, scores, rtol=0, atol=1e-9)


def test_largest_places_follow_size_then_order():
    nan = float("nan")
    rows = [[0.1, -0.5, 0.5, 0.0], [nan, 0.0, -0.0, nan], [-3.0, 2.0, 3.0, float("-inf")]]
    for more in ([], [[None, 1.0, nan, None], None, [], [2.0]]):
        got = C.largest_places(pa.array(rows + more, pa.list_(pa.float64())), 3).to_pylist()
        assert got[:3] == [[1, 2, 0], [1, 2, 0], [3, 0, 2]]
        assert got[3:] == ([[0, 3, 1], None, [], [0]] if more else [])


def test_log_odds_and_terms_are_worked_out_in_one_pass(spark, rows, boosted):
    df, _ = rows
    terms, _ = C.contributions_column(spark, boosted)
    plan = df.select(B.log_odds_column(spark, boosted), terms)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1
