"""Leaf-wise trees against a plain version over all rows in one place."""

import heapq
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.operators import boosting as B, contributions as C, leafwise as L
from tidemark.session import fresh_path

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    n = 1_600
    frame = pd.DataFrame(rng.normal(size=(n, 3)).round(2), columns=COLUMNS)
    frame.loc[rng.random(n) < 0.3, "b"] = np.nan
    odds = 2 * frame["a"].clip(-1, 1) + np.where(frame["b"].isna(), 1.5, -frame["b"]) * (frame["c"] > 0.3) - 2
    frame[S.LABEL] = (rng.random(n) < 1 / (1 + np.exp(-odds))).astype("int32")
    frame[S.KEY] = np.arange(n)
    frame[S.SPLIT] = np.where(np.arange(n) < 1_100, "train", "val")
    df = spark.createDataFrame(frame).repartition(3).cache()
    return df, frame


def part(rows, name):
    return rows[0].where(F.col(S.SPLIT) == name)


def soft(g, l1):
    return math.copysign(max(abs(g) - l1, 0.0), g)


def plain_split(values, g, h, cuts, params):
    """Best (gain, feature, cut, missing left, mask of the left) over all features, by trying each."""
    def score(mask):
        den = h[mask].sum() + params.l2
        return soft(g[mask].sum(), params.l1) ** 2 / den if den > 0 else 0.0

    best = (-math.inf,)
    everything = np.ones(len(g), bool)
    for f in range(values.shape[1]):
        for cut in cuts[f]:
            for side in (False, True):
                left = (values[:, f] <= cut) | (np.isnan(values[:, f]) & side)
                if min(left.sum(), (~left).sum()) < params.min_rows_per_leaf:
                    continue
                gain = score(left) + score(~left) - score(everything)
                if gain > best[0] + 1e-9:
                    best = (gain, f, float(cut), side, left)
    return best


def plain_tree(values, g, h, cuts, params):
    """Leaves ``(mask, value)`` of a tree grown best leaf first, and its splits in order."""
    count = itertools_count()
    start = np.arange(len(g))
    heap, leaves, splits = [], [], []

    def push(index, depth):
        found = plain_split(values[index], g[index], h[index], cuts, params) if depth < params.max_depth else (-math.inf,)
        heapq.heappush(heap, (-found[0], next(count), index, depth, found))

    push(start, 0)
    while heap and len(splits) < params.leaves - 1 and -heap[0][0] > 0:
        _, _, index, depth, found = heapq.heappop(heap)
        splits.append(found[:4])
        push(index[found[4]], depth + 1)
        push(index[~found[4]], depth + 1)
    for _, _, index, *_ in heap:
        den = h[index].sum() + params.l2
        leaves.append((index, -params.step_size * soft(g[index].sum(), params.l1) / den))
    return leaves, splits


def itertools_count():
    n = 0
    while True:
        yield n
        n += 1


@pytest.mark.parametrize("params", [
    L.LeafParams(leaves=7, max_depth=9, min_rows_per_leaf=15, feature_share=1, row_share=1, l1=0.8, l2=2.0, step_size=0.3),
    L.LeafParams(leaves=31, max_depth=3, min_rows_per_leaf=5, feature_share=1, row_share=1, step_size=0.2),
    L.LeafParams(leaves=4, max_depth=8, min_rows_per_leaf=40, feature_share=1, row_share=1, l2=0.1),
])
def test_trees_equal_a_plain_version(rows, params):
    df, frame = rows
    train = frame[frame[S.SPLIT] == "train"]
    cuts = [np.linspace(-1.5, 1.5, 13)] * 3
    booster = L.start(part(rows, "train"), COLUMNS, params, weight=3.0, cuts=cuts).advance(3)
    values, y = train[COLUMNS].to_numpy(), train[S.LABEL].to_numpy()
    w = np.where(y == 1, 3.0, 1.0)
    base = math.log((w * y).sum() / (w * (1 - y)).sum())
    margin = np.full(len(y), base)
    for number in range(3):
        p = 1 / (1 + np.exp(-margin))
        leaves, splits = plain_tree(values, w * (p - y), w * p * (1 - p), cuts, params)
        for index, value in leaves:
            margin[index] += value
        nodes = booster.frames[number]
        inner = nodes[nodes.feature >= 0]
        assert sorted(zip(inner.gain.round(6), inner.feature, inner.threshold, inner.missing)) == sorted((round(g, 6), f, c, int(s)) for g, f, c, s in splits)
        assert sorted(nodes[nodes.feature < 0].cover) == sorted(len(i) for i, _ in leaves)
    got = B.predict(part(rows, "train"), booster.ensemble()).toPandas().set_index(S.KEY)["probability"]
    assert got.loc[train[S.KEY]].to_numpy() == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-12)


def test_scores_written_between_rounds_change_nothing(rows, monkeypatch):
    params = L.LeafParams(leaves=5, max_depth=3, row_share=0.7, feature_share=0.67)
    one = L.start(part(rows, "train"), COLUMNS, params).advance(5).ensemble().nodes
    monkeypatch.setattr(L, "ROUNDS_PER_TABLE", 2)
    resumed = L.start(part(rows, "train").repartition(5), COLUMNS, params)
    two = resumed.advance(2).advance(3).ensemble().nodes
    pd.testing.assert_frame_equal(one, two, rtol=1e-9)


def test_missing_values_find_their_side(rows):
    params = L.LeafParams(leaves=8, max_depth=4, feature_share=1, row_share=1)
    trees = L.start(part(rows, "train"), COLUMNS, params).advance(2).ensemble()
    assert trees.nodes[trees.nodes.feature == 1].missing.any()
    # Missing values move a row's score, and its terms still add up to it.
    df, _ = rows
    terms, base = C.contributions_column(df.sparkSession, trees)
    total = F.aggregate(terms, F.lit(base), lambda acc, c: acc + c)
    assert df.select(F.abs(total - B.log_odds_column(df.sparkSession, trees)).alias("d")).agg(F.max("d")).first()[0] < 1e-10
    path = fresh_path(df.sparkSession, "trees")
    trees.save(df.sparkSession, path)
    loaded = B.Ensemble.load(df.sparkSession, path)
    assert loaded.nodes.missing.tolist() == trees.nodes.missing.tolist()


def test_patience_ends_the_rounds(rows):
    params = L.LeafParams(leaves=6, max_depth=3, step_size=0.5, feature_share=1)
    trees = L.fit_leafwise(part(rows, "train"), part(rows, "val"), COLUMNS, params, max_rounds=5_000, patience=6)
    seen = [number for number, _ in trees.log]
    assert seen == list(range(1, len(seen) + 1)) and len(seen) < 200
    assert trees.rounds == B.stop_round(trees.log, 6) and len(seen) - trees.rounds >= 6


def test_odd_tables(spark, rows):
    params = L.LeafParams(leaves=4, max_depth=3, min_rows_per_leaf=1)
    same = part(rows, "train").withColumn("a", F.lit(1.0)).withColumn("b", F.lit(None).cast("double")).withColumn("c", F.lit(2.0))
    trees = L.start(same, COLUMNS, params).advance(2).ensemble()
    assert len(trees.nodes) == 2 and (trees.nodes.feature < 0).all()
    nobody = part(rows, "train").where(F.col(S.LABEL) == 0)
    chance = B.predict(nobody, L.start(nobody, COLUMNS, params, weight=1.0).advance(1).ensemble())
    assert chance.select(F.max("probability")).first()[0] <= 0.5


def test_cuts_leave_a_bin_for_every_side(rows):
    df, frame = rows
    cuts = L.fit_cuts(df, COLUMNS, 16)
    assert all(1 <= len(c) <= 14 and (np.diff(c) > 0).all() for c in cuts)
    assert all(np.nanmin(frame[n]) <= c[0] and c[-1] <= np.nanmax(frame[n]) for n, c in zip(COLUMNS, cuts))


def test_halving_finds_what_the_full_search_finds(rows):
    train, held = part(rows, "train"), part(rows, "val")
    log, best = L.search_leafwise(train, held, COLUMNS, trials=4, max_rounds=6, patience=6, sample_fraction=0.6)
    got = sorted(log.collect(), key=lambda r: (r["rung"], r["trial"]))
    assert [(r["rung"], r["trial"]) for r in got if r["rung"] == 0] == [(0, i) for i in range(4)]
    assert L.rungs(4, 6) == [2, 6] and {r["rounds"] for r in got if r["rung"] == 0} == {2}
    assert {r["state"] for r in got} == {"kept", "dropped", "done"} and sum(r["rung"] == 1 for r in got) == 2
    full = {}
    for i, params in enumerate(L.draw_trials(4)):
        weight = B.positive_class_weight(train).first()["weight"]
        sample = L.stratified_sample(train.select(S.KEY, S.LABEL, *COLUMNS), S.LABEL, fraction=0.6, seed=42)
        booster = L.start(sample, COLUMNS, params, weight=weight).advance(6)
        scored = B.staged_auroc(held, booster.ensemble(), S.LABEL)
        full[i] = dict(scored)[B.stop_round(scored, 6)]
    last = {r["trial"]: r["value"] for r in got if r["rung"] == 1}
    assert all(v == pytest.approx(full[i], abs=1e-12) for i, v in last.items())
    assert max(r["value"] for r in got) >= max(full.values()) - 1e-12 and best in L.draw_trials(4)
    for params in L.draw_trials(200):
        assert all(low <= getattr(params, name) <= high for name, (low, high) in L.SEARCH_SPACE.items())


def test_rungs():
    assert L.rungs(50, 300) == [11, 33, 100, 300] and L.rungs(1, 300) == [300] and L.rungs(9, 1) == [1]


def test_gathered_sums_grow_the_trees_of_the_shuffled_ones(rows, monkeypatch):
    params = L.LeafParams(leaves=8, max_depth=4, row_share=0.7, feature_share=0.7, max_bins=16)
    gathered = L.start(part(rows, "train"), COLUMNS, params)
    assert gathered._few_sums(len(COLUMNS))
    monkeypatch.setattr(L.Booster, "_level", None)
    few = gathered.advance(12).ensemble().nodes  # beyond the round that writes the scores
    monkeypatch.undo()
    monkeypatch.setattr(L, "GATHERED_BYTES", 0)
    many = L.start(part(rows, "train"), COLUMNS, params).advance(12).ensemble().nodes
    pd.testing.assert_frame_equal(few, many)


def test_binned_rows_are_read_as_blocks(rows):
    train = part(rows, "train")
    booster = L.start(train, COLUMNS, L.LeafParams(leaves=4, max_depth=2))
    assert booster.rows.count() <= booster.tasks * 4 < train.count()
    got = booster.rows.selectExpr("sum(octet_length(bins))", "sum(octet_length(y)) / 8").first()
    assert tuple(got) == (train.count() * len(COLUMNS), train.count())


@pytest.mark.parametrize("depth, leaves", [(4, 15), (9, 150)])
def test_rows_find_their_nodes_by_conditions_and_by_look_ups(depth, leaves):
    rng = np.random.default_rng(5)
    nodes = [L._Node(0)]
    for i, x in enumerate(nodes):
        if x.depth < depth and len(nodes) < 2 * leaves - 1 and (not i or rng.random() < 0.9):
            x.feature, x.bin, x.missing, x.left, x.right = int(rng.integers(3)), int(rng.integers(1, 60)), bool(rng.random() < 0.5), len(nodes), len(nodes) + 1
            nodes += [L._Node(x.depth + 1), L._Node(x.depth + 1)]
    bins = rng.integers(0, 62, (3, 500)).astype(np.uint8)
    tree = L._Arrays(nodes)
    assert (tree.steps is None) == (depth == 9)

    def node_of(row):
        at = 0
        while nodes[at].left >= 0:
            x = nodes[at]
            code = row[x.feature]
            at = x.left if (x.missing if code == L.MISSING else code <= x.bin) else x.right
        return at

    assert tree.nodes_of(bins).tolist() == [node_of(row) for row in bins.T]


def test_rounds_read_rows_that_the_executors_keep(rows, monkeypatch):
    spark = rows[0].sparkSession
    params = L.LeafParams(leaves=4, max_depth=2)
    booster = L.start(part(rows, "train"), COLUMNS, params)
    assert booster.few
    kept = spark.sparkContext._jsc.getPersistentRDDs()
    assert booster.kept.is_cached and kept.containsKey(booster.kept.id())
    # No table is scanned or written for a level; after ten rounds the scores are a checkpoint.
    monkeypatch.setattr(L, "written", None)
    monkeypatch.setattr(type(booster.rows), "mapInArrow", None)
    first = booster.kept.id()
    booster.advance(L.ROUNDS_PER_TABLE)
    assert booster.kept.isCheckpointed() and not booster.recent
    assert not spark.sparkContext._jsc.getPersistentRDDs().containsKey(first)
    booster.release()
    assert booster.advance(1).rounds == L.ROUNDS_PER_TABLE + 1


def test_held_rows_are_ranked_as_their_values(rows, monkeypatch):
    held = part(rows, "val").withColumn(S.LABEL, F.when(F.col(S.KEY) % 7 != 0, F.col(S.LABEL)))
    # A third of the rows are copies of one, so that scores are tied.
    held = held.unionByName(held.where(S.LABEL + " = 1").limit(1).withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(200)))).drop("_n"))
    booster = L.start(part(rows, "train"), COLUMNS, L.LeafParams(leaves=6, max_depth=3))
    booster.advance(7)
    want = B.staged_auroc(held, booster.ensemble(), S.LABEL)
    for rows_of_range, rounds in ((B.RANKED_ROWS, 25), (50, 3)):
        monkeypatch.setattr(B, "RANKED_ROWS", rows_of_range)
        monkeypatch.setattr(L, "STAGES_PER_JOB", rounds)
        monkeypatch.setattr(L, "SORTED_ROWS", 100)
        ranked = L.Held(held, booster)
        got = ranked.auroc(booster.fresh[:4]) + ranked.auroc(booster.fresh[4:])
        assert [number for number, _ in got] == list(range(1, 8))
        assert [v for _, v in got] == pytest.approx([v for _, v in want], abs=1e-12)
