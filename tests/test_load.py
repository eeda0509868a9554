import logging

import pytest
from pyspark.sql import functions as F, types as T

from tidemark import schema as S
from tidemark.operators import validate as V
from tidemark.operators.joins import identity_coverage, merge_identity
from tidemark.session import fresh_path
from tidemark.settings import Settings, load_settings
from tidemark.sources import files


@pytest.fixture
def pair(spark):
    tx = spark.createDataFrame([(i, 86400 + 3600 * i, 100.0 + i, int(i == 1)) for i in range(1, 6)],
                               "TransactionID bigint, TransactionDT bigint, TransactionAmt double, isFraud int")
    idn = spark.createDataFrame([(1, -5.0, "mobile"), (2, -5.0, "mobile")], "TransactionID bigint, id_01 double, DeviceType string")
    return tx, idn


def test_merge_keeps_every_transaction_and_adds_no_indicator(pair):
    merged = merge_identity(*pair)
    assert merged.count() == 5
    assert set(merged.columns) == set(pair[0].columns) | {"id_01", "DeviceType"}
    assert [r[0] for r in merged.where(F.col("id_01").isNull()).orderBy(S.KEY).select(S.KEY).collect()] == [3, 4, 5]


def test_coverage_counts_matches_not_payload_values(spark, pair):
    idn = pair[1].withColumn("id_01", F.lit(None).cast("double"))
    assert tuple(identity_coverage(pair[0], idn).first()) == (2, 5, 40.0)


@pytest.mark.parametrize("which, column, message", [
    (0, "isFraud", "Transaction table missing required columns"),
    (0, "TransactionDT", "TransactionDT"),
    (1, "TransactionID", "Identity table missing required columns"),
])
def test_absent_columns_are_named(pair, which, column, message):
    frames = list(pair)
    frames[which] = frames[which].drop(column)
    with pytest.raises(ValueError, match=message):
        V.validate_raw(*frames)


@pytest.mark.parametrize("which, name", [(0, "Transaction"), (1, "Identity")])
def test_duplicate_keys_raise(pair, which, name):
    frames = list(pair)
    frames[which] = frames[which].union(frames[which].limit(1))
    with pytest.raises(ValueError, match=f"{name} table has 1 duplicate"):
        V.validate_raw(*frames)


def test_merged_checks(pair, caplog):
    merged = merge_identity(*pair)
    with pytest.raises(ValueError, match="missing required"):
        V.validate_merged(merged.drop("isFraud"))
    with pytest.raises(ValueError, match="duplicate"):
        V.validate_merged(merged.union(merged))
    with pytest.raises(ValueError, match=r"unexpected values: \[7\]"):
        V.validate_merged(merged.withColumn("isFraud", F.lit(7)))
    with caplog.at_level(logging.WARNING):
        V.validate_merged(merged.withColumn("isFraud", F.lit(1)))
    assert "outside the expected range" in caplog.text
    # A missing label is not a wrong one.
    V.validate_merged(merged.withColumn("isFraud", F.when(F.col(S.KEY) > 1, F.col("isFraud"))))


def test_csv_round_trip_with_missing_tokens(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,whole,gappy,number,code,word\n1,1,1,1.5,1D,NA\n2,2,NaN,,2F,x\n3,3,3,2e3,N/A,null\n")
    df = files.read_csv(spark, str(path))
    assert dict(df.dtypes) == {"id": "bigint", "whole": "bigint", "gappy": "double", "number": "double", "code": "string", "word": "string"}
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, 1, 1.0, 1.5, "1D", None), (2, 2, None, None, "2F", "x"), (3, 3, 3.0, 2000.0, None, None)
    ]
    typed = files.read_csv(spark, str(path), T.StructType([T.StructField("whole", T.DoubleType())]))
    assert dict(typed.dtypes)["whole"] == "double"


def test_missing_tables_raise_with_guidance(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="run the merge first"):
        files.read_table(spark, str(tmp_path / "none"), "run the merge first")
    with pytest.raises(FileNotFoundError):
        files.VersionedTable(spark, str(tmp_path / "none")).read()


def test_versions_survive_being_read_while_replaced(spark, tmp_path):
    table = files.VersionedTable(spark, str(tmp_path / "t"))
    table.write(spark.range(3).select(F.col("id").alias(S.KEY), F.lit(9.0).alias(S.SCORE)))
    old = table.read()
    new = files.append_score(table, spark.range(3).select(F.col("id").alias(S.KEY), (F.col("id") * 2.0).alias(S.SCORE)))
    assert sorted(r[S.SCORE] for r in new.collect()) == [0.0, 2.0, 4.0]
    assert sorted(r[S.SCORE] for r in old.collect()) == [9.0, 9.0, 9.0]
    assert sorted(r[S.SCORE] for r in files.append_column(table, S.SCORE, F.col(S.KEY) + 0.5).collect()) == [0.5, 1.5, 2.5]
    # A folder without a finished write is not a version.
    (tmp_path / "t" / "99999999-broken").mkdir()
    assert table.read().count() == 3 and len(table.versions()) == 3


def test_resume_builds_once(spark):
    path, calls = fresh_path(spark, "resume"), []

    def build():
        calls.append(1)
        return spark.range(4)

    assert files.unless_exists(spark, path, build).count() == 4
    assert files.unless_exists(spark, path, build).count() == 4
    assert len(calls) == 1


def test_split_read_prunes_other_splits(spark):
    path = fresh_path(spark, "splits")
    files.write_splits(spark.range(9).select("id", F.when(F.col("id") < 5, "train").otherwise("val").alias("split")), path)
    part = files.read_split(spark, path, "val")
    assert part.count() == 4
    assert "PartitionFilters: [isnotnull(split" in part._jdf.queryExecution().executedPlan().toString()


def test_settings_fall_back_to_defaults(tmp_path):
    nested = {"split": {"test_size": 0.1}, "models": {"optuna": {"n_trials": 100}, "isolation_forest": None}}
    settings = Settings.from_mapping(nested)
    assert (settings.test_size, settings.val_size, settings.search_trials, settings.forest_trees) == (0.1, 0.15, 100, 200)
    path = tmp_path / "s.yaml"
    path.write_text('{"features": {"missing_threshold": 0.5}}')
    assert load_settings(str(path)).missing_threshold == 0.5


def test_row_rules_name_the_field(spark):
    rows = [
        (1, 86400, 99.0, "T", "M0"), (2, 1, -1.0, None, None), (3, 1, 0.0, None, None), (4, 1, 2e6, None, None),
        (5, None, 5.0, None, None), (6, 1, None, None, None), (7, 1, 5.0, "yes", None), (8, 1, 5.0, "T", "X99"),
        (9, 1, 1e6, "F", "M2"), (10, None, float("nan"), "1", "M3"),
    ]
    df = spark.createDataFrame(rows, "TransactionID bigint, TransactionDT bigint, TransactionAmt double, M5 string, M4 string")
    got = {r[0]: r[1] for r in V.check_rows(df).select(S.KEY, "errors").collect()}
    assert got == {
        1: [], 2: [S.AMOUNT], 3: [S.AMOUNT], 4: [S.AMOUNT], 5: [S.TIME], 6: [S.AMOUNT], 7: ["M5"], 8: ["M4"], 9: [],
        10: [S.TIME, S.AMOUNT, "M5", "M4"],
    }
    no_amount = V.check_rows(df.drop(S.AMOUNT))
    assert all(S.AMOUNT in r["errors"] for r in no_amount.collect())


def test_quotes_and_long_keys_are_read_whole(spark, tmp_path):
    (tmp_path / "t.csv").write_text('TransactionID,note,n\n1234567890123456789,"a ""b"", c",1\n1234567890123456788,x,2\n')
    rows = {r[S.KEY]: r["note"] for r in files.read_csv(spark, str(tmp_path)).collect()}
    assert rows == {1234567890123456789: 'a "b", c', 1234567890123456788: "x"}


def test_key_beyond_bigint_is_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text("TransactionID,n\n99999999999999999999,1\n99999999999999999998,2\n")
    assert files.read_csv(spark, str(tmp_path)).select(S.KEY).distinct().count() == 2


def test_histogram_keeps_rows_without_a_group(spark):
    from tidemark.operators.profile import histogram

    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0), (None, 5.0), ("b", 4.0)], "g string, x double")
    rows = histogram(df, "x", 2, ["g"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 1
    assert sum(r["n_rows"] for r in rows.collect()) == 5
