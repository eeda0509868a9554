import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions import scalars as X
from tidemark.operators import encoders as E, profile as P, splitting as L
from tidemark.session import fresh_path


def column(df, name, order=S.KEY):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


def test_dropper_is_strict_and_learns_from_train_only(spark):
    rows = [(i, 1.0 if i < 15 else None, 1.0 if i < 50 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "TransactionID bigint, mostly double, half double")
    model = E.HighMissingDropper(threshold=0.7).fit(df)
    assert model.transform(df).columns == [S.KEY, "half"]
    assert "unseen" in model.transform(df.withColumn("unseen", F.lit(None).cast("double"))).columns
    exact = spark.createDataFrame([(i, 1.0 if i < 3 else None) for i in range(10)], "TransactionID bigint, x double")
    assert "x" in E.HighMissingDropper(threshold=0.7).fit(exact).transform(exact).columns
    two = spark.createDataFrame([(1, 1.0, 1.0), (2, None, 1.0)], "TransactionID bigint, x double, y double")
    assert E.HighMissingDropper(threshold=0.0).fit(two).transform(two).columns == [S.KEY, "y"]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "TransactionID bigint, x double")
    assert {r["column"]: r["n_missing"] for r in P.missing_profile(df).collect()} == {S.KEY: 0, "x": 1}


def test_time_features(spark):
    df = spark.createDataFrame([(i, 3600 * i) for i in range(24 * 8)], "TransactionID bigint, TransactionDT bigint")
    model = E.TimeFeatures().fit(df)
    out = model.transform(df)
    assert S.TIME not in out.columns
    assert column(out, "hour_of_day") == [i % 24 for i in range(24 * 8)]
    assert column(out, "day_of_week") == [i // 24 % 7 for i in range(24 * 8)]
    assert column(out, "is_weekend") == [int(i // 24 % 7 >= 5) for i in range(24 * 8)]
    ends = out.agg(F.min("time_in_dataset"), F.max("time_in_dataset")).first()
    assert tuple(ends) == (0.0, 1.0)
    later = model.transform(spark.createDataFrame([(1, 3600 * 24 * 16)], df.schema)).first()
    assert later["time_in_dataset"] > 1
    before = spark.createDataFrame([(1, -1)], df.schema).select(X.hour_of_day(F.col(S.TIME)), X.day_of_week(F.col(S.TIME)))
    assert tuple(before.first()) == (23, 6)


def test_amount_features(spark):
    amounts = [5.0, 25.0, 100.0, 500.0, 2000.0, 0.0, 10.0, 50.0, 200.0, 1000.0, None]
    df = spark.createDataFrame(list(enumerate(amounts)), "TransactionID bigint, TransactionAmt double")
    out = E.AmountFeatures().transform(df)
    assert column(out, "amt_bin") == [0, 1, 2, 3, 4, 0, 0, 1, 2, 3, None]
    assert column(out, "amt_log")[:5] == pytest.approx([math.log1p(a) for a in amounts[:5]])


def test_rate_encoder_matches_the_formula(spark):
    rows = list(zip(range(5), ["gmail", "gmail", "yahoo", "gmail", None], [1, 0, 0, 1, 0]))
    df = spark.createDataFrame(rows, "TransactionID bigint, P_emaildomain string, isFraud int")
    model = E.TargetRateEncoder().fit(df)
    fresh = spark.createDataFrame([(0, "gmail"), (1, "yahoo"), (2, None), (3, "new")], "TransactionID bigint, P_emaildomain string")
    out = model.transform(fresh)
    assert column(out, "P_emaildomain_risk") == pytest.approx([6 / 13, 4 / 11, 0.4, 0.4])
    assert "P_emaildomain" not in out.columns and "R_emaildomain_risk" not in out.columns
    late = model.transform(fresh.withColumn("R_emaildomain", F.lit("gmail")))
    assert set(column(late, "R_emaildomain_risk")) == {0.4}


def test_more_smoothing_means_less_spread(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 0), (4, "b", 0)], "TransactionID bigint, P_emaildomain string, isFraud int")

    def spread(s):
        values = column(E.TargetRateEncoder(smoothing=s).fit(df).transform(df), "P_emaildomain_risk")
        return max(values) - min(values)

    assert spread(1000.0) < spread(0.01)


def test_lookup_without_broadcast_gives_the_same(spark, merged):
    train = merged.where(F.col(S.KEY) <= 40)
    model = E.TargetRateEncoder().fit(train)
    wanted = column(model.transform(merged), "P_emaildomain_risk")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = model.transform(merged)
        assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
        assert column(out, "P_emaildomain_risk") == wanted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_salted_lookup_gives_the_same(spark, merged, monkeypatch):
    from tidemark.operators import joins

    wanted = E.TargetRateEncoder().fit(merged).transform(merged)
    monkeypatch.setattr(joins, "is_broadcast", lambda table: False)
    monkeypatch.setattr(joins, "HOT_SHARE", 3)
    model = E.TargetRateEncoder().fit(merged)
    assert 1 <= len(model.hot("P_emaildomain")) <= 2 and E.TargetRateEncoderModel.hot(model, "none") == []
    salted = model.transform(merged)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert salted.columns == wanted.columns and salted.count() == wanted.count()
    assert salted.exceptAll(wanted).count() == 0


def test_final_encoder(spark):
    rows = [(1, "T", "M1", "b", 1.0), (2, "F", "M0", "a", 2.0), (3, None, None, "b", None), (4, "T", "M1", None, 4.0)]
    df = spark.createDataFrame(rows, "TransactionID bigint, M1 string, M4 string, word string, x double")
    model = E.FinalEncoder().fit(df)
    out = model.transform(df)
    assert out.columns == [S.KEY, "M1", "M4", "word", "x"] and model.features == ["M1", "M4", "word", "x"]
    assert column(out, "M1") == [1, 0, -1, 1]
    assert column(out, "M4") == [1, 0, -1, 1]
    assert column(out, "word") == [1, 0, 1, -1]
    assert column(out, "x") == [1.0, 2.0, 2.0, 4.0]
    unseen = model.transform(spark.createDataFrame([(9, "T", "M2", "z", float("nan"))], df.schema)).first()
    assert (unseen["M4"], unseen["word"], unseen["x"]) == (-1, -1, 2.0)
    even = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 2.0, 4.0, 10.0, None])], "TransactionID bigint, x double")
    assert column(E.FinalEncoder().fit(even).transform(even), "x")[-1] == 3.0
    with pytest.raises(ValueError, match="median"):
        E.FinalEncoder().fit(even.withColumn("x", F.lit(None).cast("double")))


def test_codes_are_places_in_sorted_order(spark):
    words = [(f"w{i % 97:03d}", f"k{i % 5}") for i in range(1_000)]
    df = spark.createDataFrame(words, "a string, b string").repartition(6)
    codes = E.ordinal_codes(df, ["a", "b"]).orderBy("column", "category").collect()
    assert [r["value"] for r in codes] == [*range(97), *range(5)] and sum(r["n"] for r in codes) == 2_000


@pytest.fixture(scope="module")
def fitted(merged):
    splitter = L.TemporalSplitter(testSize=0.2, valSize=0.2).fit(merged)
    return splitter, E.build_pipeline().fit(splitter.select(merged, "train"))


def test_pipeline_output_is_numeric_complete_and_alike_for_all_splits(merged, fitted):
    splitter, pipeline = fitted
    out = pipeline.transform(splitter.transform(merged)).cache()
    features = E.final_encoder(pipeline).features
    assert out.columns == [S.KEY, S.LABEL, S.SPLIT, *features]
    assert set(features) <= set(P.numeric_columns(out))
    assert P.missing_cells(out).first()[0] == 0
    assert out.count() == 60 and "mostly_missing" not in features and "rarely_missing" in features
    assert "P_emaildomain_risk" in features and "R_emaildomain" not in features
    check = out.select(F.max(F.abs(F.col("amt_log") - F.log1p(S.AMOUNT)))).first()[0]
    assert check < 1e-12


def test_input_columns_are_the_raw_ones_without_duplicates(merged, fitted):
    names = E.input_columns(fitted[1])
    assert len(names) == len(set(names)) and names[0] == S.TIME
    assert {"P_emaildomain", "M1", "M4", "card4", S.AMOUNT} <= set(names)
    assert not {"amt_log", "hour_of_day", "P_emaildomain_risk", "mostly_missing", S.KEY, S.LABEL} & set(names)
    assert set(names) <= set(merged.columns)


def test_pipeline_survives_saving(spark, merged, fitted):
    path = fresh_path(spark, "pipeline")
    fitted[1].save(path)
    loaded = PipelineModel.load(path)
    assert loaded.transform(merged).exceptAll(fitted[1].transform(merged)).count() == 0
    assert E.pipeline_summary(spark, loaded).collect() == E.pipeline_summary(spark, fitted[1]).collect()


def test_splits_are_sized_ordered_and_disjoint(spark):
    df = spark.createDataFrame([(i, 3600 * (i // 3), i % 9 == 0) for i in range(100)], "TransactionID bigint, TransactionDT bigint, f boolean")
    df = df.withColumn(S.LABEL, F.col("f").cast("int"))
    model = L.TemporalSplitter(testSize=0.2, valSize=0.15).fit(df)
    out = model.transform(df)
    assert {r[0]: r[1] for r in out.groupBy(S.SPLIT).count().collect()} == {"train": 65, "val": 15, "test": 20}
    for split in ("train", "val", "test"):
        assert model.select(df, split).exceptAll(out.where(F.col(S.SPLIT) == split)).count() == 0
    summary = {r["split"]: r for r in L.split_summary(out).collect()}
    assert summary["train"]["dt_max"] <= summary["val"]["dt_min"] and summary["val"]["dt_max"] <= summary["test"]["dt_min"]
    assert L.split_overlap(out).count() == 0
    path = fresh_path(spark, "splitter")
    model.save(path)
    assert L.TemporalSplitModel.load(path).transform(df).exceptAll(out).count() == 0


@pytest.mark.parametrize("n, expected", [(100, (65, 15, 20)), (590_540, (383_851, 88_581, 118_108))])
def test_split_sizes(spark, n, expected):
    df = spark.range(n).select(F.col("id").alias(S.KEY), (F.col("id") % 1000).alias(S.TIME))
    model = L.TemporalSplitter().fit(df)
    assert tuple(model.select(df, s).count() for s in ("train", "val", "test")) == expected


def test_split_predicate_reaches_the_scan(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(F.col("o_orderkey").alias(S.KEY), F.col("o_custkey").alias(S.TIME))
    model = L.TemporalSplitter().fit(orders)
    plan = model.select(orders, "val")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThan" in plan.split("PushedFilters")[1]


def test_samples_have_exact_sizes_and_repeat(skewed):
    df, frame = skewed
    sample = L.stratified_sample(df, "y", "id", 0.3)
    counts = {r[0]: r[1] for r in sample.groupBy("y").count().collect()}
    assert counts == {c: int((frame.y == c).sum() * 0.3) for c in (0, 1)}
    assert sample.exceptAll(L.stratified_sample(df.repartition(7), "y", "id", 0.3)).count() == 0
    assert sample.select("id").distinct().count() == sum(counts.values())
    assert L.stratified_sample(df, "y", "id", 1.0) is df
    assert L.uniform_sample(df, 123, "id").count() == 123
    assert L.uniform_sample(df, 10**6, "id") is df


def test_hash_is_spread_evenly(spark):
    hashed = spark.range(200_000).select(X.portable_hash(F.col("id"), 7).alias("h"))
    counts = [r[1] for r in hashed.groupBy(F.floor(F.col("h") / (2_147_483_647 / 20))).count().collect()]
    assert min(counts) > 9_500 and max(counts) < 10_500


def test_families():
    names = {"V12": "V", "C3": "C", "D15": "D", "DeviceType": "other", "M4": "M", "id_07": "id", "card6": "card", "addr2": "addr", "dist1": "other"}
    assert {n: S.family_of(n) for n in names} == names
