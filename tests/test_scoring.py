import json

import pytest
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.operators import boosting, contributions as C, curves as R, leafwise
from tidemark.plans import reports, scoring, training
from tidemark.session import fresh_path
from tidemark.settings import Settings
from tidemark.sources import files, tables
from tidemark.streaming import jobs, ledger

SETTINGS = Settings(test_size=0.2, val_size=0.2, max_rounds=4, patience=2, forest_trees=10, explain_rows=20)


@pytest.fixture(scope="module")
def model(merged):
    return training.train(merged, SETTINGS, leafwise.LeafParams(leaves=4, max_depth=2, min_rows_per_leaf=2))


def test_scores_keep_the_contract(merged, model):
    got = scoring.score(merged, model.bundle).collect()
    assert len(got) == 60
    for row in got:
        assert 0 <= row["probability"] <= 1 and row["threshold"] == model.bundle.threshold
        assert row["is_flagged"] == (row["probability"] >= row["threshold"]) or abs(row["probability"] - row["threshold"]) < 1e-6
        assert len(row["top_factors"]) == 3
        sizes = [abs(f["shap_value"]) for f in row["top_factors"]]
        assert sizes == sorted(sizes, reverse=True)
        for factor in row["top_factors"]:
            assert factor["direction"] == ("increases_risk" if factor["shap_value"] > 0 else "decreases_risk")
            assert factor["feature"] in model.bundle.features


def test_scoring_equals_the_training_rows_and_repeats(merged, model):
    online = scoring.score(merged, model.bundle).select(S.KEY, "probability")
    batch = model.scored.select(S.KEY, F.round("probability", 6).alias("probability"))
    assert online.exceptAll(batch).count() == 0
    assert online.exceptAll(scoring.score(merged.repartition(5), model.bundle).select(S.KEY, "probability")).count() == 0


def test_minimal_and_extended_records(spark, model):
    minimal = spark.createDataFrame([(1, 86400, 99.0)], "TransactionID bigint, TransactionDT bigint, TransactionAmt double")
    extended = minimal.withColumn("V1", F.lit(0.3)).withColumn("V999", F.lit(1.0)).withColumn("label_of_nothing", F.lit("x"))
    for frame in (minimal, extended):
        row = scoring.score(frame, model.bundle).first()
        assert 0 <= row["probability"] <= 1 and len(row["top_factors"]) == 3


def test_bundle_survives_saving(spark, merged, model):
    path = fresh_path(spark, "bundle")
    with pytest.raises(FileNotFoundError, match="no fitted bundle"):
        training.Bundle.load(spark, path)
    model.bundle.save(spark, path)
    loaded = training.Bundle.load(spark, path)
    assert loaded.threshold == model.bundle.threshold and loaded.inputs == model.bundle.inputs
    assert scoring.score(merged, loaded).exceptAll(scoring.score(merged, model.bundle)).count() == 0


def test_scoring_shuffles_nothing(merged, model):
    plan = scoring.score(merged, model.bundle)._jdf.queryExecution().executedPlan().toString()
    own = plan.split("InMemoryTableScan")[0]
    assert "Exchange hashpartitioning" not in own and "SinglePartition" not in own


def test_json_records_are_checked_and_scored(spark, model, tmp_path):
    good = {"TransactionID": 7, "TransactionDT": 86400, "TransactionAmt": 10.5, "M1": "T", "V2": 0.25, "zzz": "kept"}
    bad = {"TransactionID": 8, "TransactionDT": "soon", "TransactionAmt": -3}
    (tmp_path / "r.json").write_text("\n".join(json.dumps(r) for r in (good, bad)))
    known = [f for f in model.bundle.inputs if f.name in (S.TIME, S.AMOUNT, "M1")]
    from pyspark.sql import types as T

    records = files.read_records(spark, str(tmp_path), T.StructType([T.StructField(S.KEY, T.LongType()), *known]))
    scored, held = scoring.score_checked(records, model.bundle)
    assert [r[S.KEY] for r in scored.collect()] == [7]
    assert [(r[S.KEY], r["errors"]) for r in held.collect()] == [(8, [S.TIME, S.AMOUNT])]
    assert records.where(f"{S.KEY} = 8").first()["misfits"] == [S.TIME]
    # A template field that came as an extra is used.
    assert scoring.encode(records, model.bundle).where(f"{S.KEY} = 7").first()["V2"] == 0.25
    assert records.where(f"{S.KEY} = 7").first()["extras"] == {"V2": "0.25", "zzz": "kept"}
    # The same records as a stream.
    lines, out = spark.readStream.text(str(tmp_path)), fresh_path(spark, "json-out")
    stream = files.parse_records(lines, T.StructType([T.StructField(S.KEY, T.LongType()), *known]))
    jobs.finish(jobs.score_stream(stream, model.bundle, out, fresh_path(spark, "json-progress")), 300)
    assert spark.read.parquet(f"{out}/scored").drop("batch").exceptAll(scored).count() == 0
    assert spark.read.parquet(f"{out}/quarantine").first()["errors"] == [S.TIME, S.AMOUNT]


def test_stream_scores_equal_batch_scores(spark, merged, model):
    source, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    spoiled = merged.withColumn(S.AMOUNT, F.when(F.col(S.KEY) % 10 != 0, F.col(S.AMOUNT)).otherwise(-1.0))
    spoiled.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(spoiled.schema).option("maxFilesPerTrigger", 2).parquet(source)
    progress = fresh_path(spark, "progress")
    jobs.finish(jobs.score_stream(stream, model.bundle, out, progress), 300)
    jobs.finish(jobs.score_stream(stream, model.bundle, out, progress), 300)  # nothing new: nothing doubled
    scored, held = scoring.score_checked(spoiled, model.bundle)
    got = spark.read.parquet(f"{out}/scored").drop("batch")
    assert got.count() == 54 and got.exceptAll(scored).count() == 0
    assert spark.read.parquet(f"{out}/quarantine").count() == held.count() == 6


def test_late_rows_are_dropped_and_windows_follow_the_clock(spark):
    source, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    week = S.SECONDS_PER_WEEK
    shape = "TransactionID bigint, TransactionDT bigint, isFraud int"
    batches = [[(1, 10, 1), (2, week + 5, 0)], [(3, 4 * week, 1)], [(4, 20, 1), (5, 4 * week + 9, 0)]]
    for batch in batches:
        spark.createDataFrame(batch, shape).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(shape).parquet(source)
        jobs.finish(jobs.update_stream(jobs.windowed_rate(stream), out, source + "-progress"), 300)
    newest = jobs.latest(spark.read.parquet(out), ["start"])
    got = sorted(tuple(r) for r in newest.select(jobs.week_of(F.col("start")), "rate", "n_rows").collect())
    assert got == [(0, 1.0, 1), (1, 0.0, 1), (4, 0.5, 2)]


def test_duplicates_are_dropped_across_micro_batches(spark):
    source, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    shape = "TransactionID bigint, TransactionDT bigint"
    for batch in ([(1, 10), (1, 10), (2, 11)], [(1, 10), (3, 12)]):
        spark.createDataFrame(batch, shape).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(shape).parquet(source)
        jobs.finish(jobs.append_stream(jobs.without_duplicates(stream), out, source + "-progress"), 300)
    assert sorted(r[0] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_tagged_scores_equal_both_outcomes_in_one_scan(spark, merged, model):
    source, root, progress = fresh_path(spark, "in"), fresh_path(spark, "out"), fresh_path(spark, "progress")
    spoiled = merged.withColumn(S.AMOUNT, F.when(F.col(S.KEY) % 10 != 0, F.col(S.AMOUNT)).otherwise(-1.0))
    spoiled.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(spoiled.schema).option("maxFilesPerTrigger", 2).parquet(source)
    jobs.finish(ledger.score_stream(stream, model.bundle, root, progress), 300)
    tagged = ledger.tagged_scores(spark.read.parquet(source), model.bundle)
    rows = ledger.Ledger(spark, root).read(tagged.schema)
    scored, held = scoring.score_checked(spoiled, model.bundle)
    got = rows.where(F.col(ledger.OUTCOME) == ledger.SCORED)
    assert got.count() == 54 and got.select(scored.columns).exceptAll(scored).count() == 0
    kept = rows.where(F.col(ledger.OUTCOME) == ledger.QUARANTINED)
    assert kept.select(S.KEY, "errors").exceptAll(held.select(S.KEY, "errors")).count() == 0 and kept.count() == 6
    assert kept.where("probability IS NOT NULL OR top_factors IS NOT NULL").count() == 0
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    # The other scans are the encoders' lookup tables.
    assert plan.count("FileScan parquet [TransactionID") == 1 and "Exchange hashpartitioning" not in plan


def test_ledger_reads_every_batch_once_and_whole(spark):
    root = fresh_path(spark, "ledger")
    book, rows = ledger.Ledger(spark, root), spark.range(3)
    assert book.read(rows.schema).count() == 0
    # A write that was lost half-way has no marker; the replay of its batch is the one that counts.
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/batch={0:012d}-lost")
    assert book.read(rows.schema).count() == 0
    assert book.commit(0, rows) and not book.commit(0, spark.range(9)) and book.commit(1, spark.range(5))
    assert sorted(tuple(r) for r in book.read(rows.schema).collect()) == sorted([(i, 0) for i in range(3)] + [(i, 1) for i in range(5)])
    assert book.read(rows.schema, below=1).count() == 3


def test_late_rows_are_counted_by_window(spark):
    source, root = fresh_path(spark, "in"), fresh_path(spark, "out")
    week = S.SECONDS_PER_WEEK
    shape = "TransactionID bigint, TransactionDT bigint, isFraud int"
    batches = [
        [(1, 10, 1), (2, week + 5, 0)], [(3, 4 * week, 1), (6, 11, None)], [(4, 20, 1), (5, 4 * week + 9, 0), (7, None, 1)], [(8, 30, 0)],
    ]
    for batch in batches:
        spark.createDataFrame(batch, shape).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(shape).parquet(source)
        jobs.finish(ledger.rate_stream(stream, root, source + "-progress"), 300)
    got = ledger.rates(spark, root).select(jobs.week_of(F.col("start")), "rate", "n_rows", "n_late")
    # Row 6 comes one second into the second week by the batch before: its window is still within a day.
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1.0, 2, 2), (1, 0.0, 1, 0), (4, 0.5, 2, 0)]


def test_removed_copies_are_counted_across_micro_batches(spark):
    source, root = fresh_path(spark, "in"), fresh_path(spark, "out")
    shape = "TransactionID bigint, TransactionDT bigint, TransactionAmt double"
    for batch in ([(1, 10, 1.0), (1, 10, 1.0), (2, 11, 2.0)], [(1, 10, 1.0), (3, 12, 3.0)]):
        spark.createDataFrame(batch, shape).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(shape).parquet(source)
        jobs.finish(ledger.delivery_stream(stream, root, source + "-progress"), 300)
    rows = ledger.first_copies(spark, root, ledger.deliveries(spark.read.parquet(source)).schema)
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 10, 1.0, 2), (2, 11, 2.0, 0), (3, 12, 3.0, 0)]


def test_file_job_runs_resumes_and_rescores(spark, transactions, identity, tmp_path):
    raw = tmp_path / "raw"
    transactions.coalesce(1).write.option("header", True).csv(str(raw / "tx.csv"))
    identity.coalesce(1).write.option("header", True).option("nullValue", "NA").csv(str(raw / "id.csv"))
    settings = Settings(
        raw_dir=str(raw), transaction_file="tx.csv", identity_file="id.csv", interim_dir=str(tmp_path / "mid"),
        processed_dir=str(tmp_path / "out"), val_size=0.2, max_rounds=2, patience=2, forest_trees=5, search_trials=1,
        search_rounds=2, search_patience=2, search_sample=0.9,
    )
    trained = training.run(spark, settings)
    assert trained.search_log.count() == 1
    merged_path = str(tmp_path / "mid" / "merged.parquet")
    assert files.table_exists(spark, merged_path) and spark.read.parquet(merged_path).count() == 60
    table = files.read_table(spark, str(tmp_path / "out" / "features.parquet"))
    assert {r[0]: r[1] for r in table.groupBy(S.SPLIT).count().collect()} == {"train": 36, "val": 12, "test": 12}
    loaded = training.Bundle.load(spark, str(tmp_path / "out" / "bundle"))
    threshold, f1, metrics = training.rescore(table.drop("probability"), loaded.trees)
    assert threshold == trained.bundle.threshold and f1 == trained.validation_f1
    assert metrics.count() == 3


def test_every_report_has_its_tables(spark, merged, model):
    rows, bundle = model.scored, model.bundle
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    log = spark.createDataFrame([(0, {"max_depth": 4.0}, 0.5), (1, {"max_depth": 5.0}, 0.4)], "trial int, params map<string,double>, value double")
    _, terms = bundle.columns(spark)
    held = test.select(S.KEY, terms.alias("t"), F.array(*[F.col(f).cast("double") for f in bundle.features]).alias("v"))
    made = {
        "exploration": reports.exploration(merged),
        "raw": reports.raw_inspection(merged),
        "processed": reports.processed_inspection(rows, bundle.features, ["M1", "M4"]),
        "distribution": reports.score_distribution(train),
        "analysis": reports.score_analysis(train, bundle.features, splits=rows.where("split <> 'test'")),
        "anomaly": reports.anomaly_results(rows, {"trees": 10, "contamination": 0.035}),
        "evaluation": reports.model_evaluation(rows, bundle.threshold),
        "history": reports.model_history(bundle.trees, log),
        "results": reports.model_results(rows, log, bundle.threshold),
        "curves": reports.test_curves(test, bundle.threshold),
        "confusion": reports.confusion_report(test, bundle.threshold),
        "thresholds": reports.threshold_report(rows.where("split = 'val'")),
        "contributions": reports.contribution_overview(held, bundle.features, "t", "v", sample=8),
        "test": reports.test_report(test, bundle.threshold, model.validation_f1),
        "rerun": reports.threshold_rerun(rows, bundle.threshold),
    }
    made["cases"] = reports.explained_cases(rows, bundle.trees, 0.0, shown=4)
    assert len(made) == 16
    may_be_empty = {("processed", "low_variance")}
    for name, report in made.items():
        for part, frame in report.items():
            assert frame.limit(1).count() == 1 or (name, part) in may_be_empty, (name, part)
    cases = made["cases"]
    assert cases["cases"].count() == 5 and cases["terms"].count() == 20
    sums = cases["terms"].groupBy(S.KEY).agg(F.sum("contribution").alias("t")).join(cases["cases"], S.KEY)
    gap = F.abs(F.col("t") + F.col("base") - F.log(F.col("probability") / (1 - F.col("probability"))))
    assert sums.select(F.max(gap)).first()[0] < 1e-9
    # Test labels stay out of the anomaly report.
    assert {r[S.SPLIT] for r in made["anomaly"]["ranking"].collect()} == {"train", "val"}
    assert made["contributions"]["beeswarm"].select(S.KEY).distinct().count() == 8
    best = made["results"]["best_trial"].first()
    assert best["trial"] == 0
