"""Streams whose results are committed batch by batch, and that count what they leave out.

A ledger is a folder of tables, one for each micro-batch number. A batch that is replayed after
its table was completed writes nothing, and a table without its completion marker is never read,
so readers see every batch once and whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import schema as S
from tidemark.operators import validate
from tidemark.plans import scoring
from tidemark.plans.training import Bundle
from tidemark.sources.files import VersionedTable
from tidemark.streaming.jobs import WINDOW_START, event_clock, latest

OUTCOME = "outcome"
SCORED, QUARANTINED = "scored", "quarantine"


class Ledger:
    """Tables by micro-batch number; the first completed table of a number is the one in force."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def batches(self) -> dict[int, str]:
        """Path of every committed batch."""
        found: dict[int, str] = {}
        for name in VersionedTable(self.spark, self.root).versions():
            found.setdefault(int(name.split("=")[1].split("-")[0]), f"{self.root}/{name}")
        return found

    def commit(self, number: int, rows: DataFrame, partition_by: str | None = None) -> bool:
        """One write; False, and no work, for a number that is committed already."""
        if number in self.batches():
            return False
        writer = rows.write.partitionBy(partition_by) if partition_by else rows.write
        writer.parquet(f"{self.root}/batch={number:012d}-{uuid.uuid4().hex}")
        return True

    def read(self, shape: T.StructType, below: int | None = None) -> DataFrame:
        """Rows of all committed batches, or of those before one, with their ``batch`` number."""
        paths = [path for number, path in self.batches().items() if below is None or number < below]
        folder = T.StructField("batch", T.StringType())
        full = T.StructType([*shape.fields, folder])
        reader = self.spark.read.schema(full).option("basePath", self.root)
        rows = reader.parquet(*paths) if paths else self.spark.createDataFrame([], full)
        return rows.withColumn("batch", F.split_part("batch", F.lit("-"), F.lit(1)).cast("long"))


def _run(rows: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (
        rows.writeStream.outputMode(mode).foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# --------------------------------------------------------------------------- scoring


def tagged_scores(records: DataFrame, bundle: Bundle) -> DataFrame:
    """Every record once, in one pass: its score, or its broken fields.

    ``outcome`` is ``scored`` (score columns, no errors) or ``quarantine`` (errors, no score).
    """
    checked = validate.check_rows(records)
    scores = scoring.score(checked, bundle, carry=("errors",))
    valid = F.size("errors") == 0
    columns = [c for c in scores.columns if c not in (S.KEY, "errors")]
    return scores.select(
        S.KEY,
        *[F.when(valid, F.col(c)).alias(c) for c in columns],
        F.when(~valid, F.col("errors")).alias("errors"),
        F.when(valid, F.lit(SCORED)).otherwise(F.lit(QUARANTINED)).alias(OUTCOME),
    )


def score_stream(records: DataFrame, bundle: Bundle, root: str, checkpoint: str) -> StreamingQuery:
    """Score a stream into a ledger with one write per micro-batch, a folder per outcome."""
    ledger = Ledger(records.sparkSession, root)
    return _run(records, lambda batch, number: ledger.commit(number, tagged_scores(batch, bundle), OUTCOME), checkpoint)


# --------------------------------------------------------------------------- rates


RATES = "start timestamp, n_rows bigint, n_labelled bigint, n_positive bigint, n_late bigint, last_at timestamp"


def _rate_sums(batch: DataFrame, reached: Column, period: str, late: str) -> DataFrame:
    window = F.window("_at", period, startTime=WINDOW_START)
    open_ = reached.isNull() | (F.col("w.end") > reached - F.expr(f"INTERVAL {late}"))
    counted = batch.withColumn("_at", event_clock()).withColumn("w", window).withColumn("open", open_)
    label = F.when(F.col("open"), F.col(S.LABEL))
    return counted.groupBy(F.col("w.start").alias("start")).agg(
        F.count_if(F.col("open")).alias("n_rows"),
        F.count(label).alias("n_labelled"),
        F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("n_positive"),
        F.count_if(~F.col("open")).alias("n_late"),
        F.max("_at").alias("last_at"),
    )


def rate_stream(transactions: DataFrame, root: str, checkpoint: str, period: str = "7 days", late: str = "1 day") -> StreamingQuery:
    """Sums per event-time window and micro-batch in a ledger, late rows counted beside them.

    A row is late when its window ended ``late`` or more before the latest event time of the
    batches before its own. Sums are mergeable, so the stream keeps no state: a batch adds one
    row for each window it meets, and reads one time from the batches before it. Rows without a
    time belong to no window and are left out.
    """
    spark = transactions.sparkSession
    ledger, shape = Ledger(spark, root), T.StructType.fromDDL(RATES)

    def sink(batch: DataFrame, number: int) -> None:
        reached = ledger.read(shape, below=number).agg(F.max("last_at")).first()[0]
        ledger.commit(number, _rate_sums(batch, F.lit(reached).cast("timestamp"), period, late))

    return _run(transactions, sink, checkpoint)


def rates(spark: SparkSession, root: str) -> DataFrame:
    """Rate, rows and late rows of every window of a :func:`rate_stream`."""
    sums = Ledger(spark, root).read(T.StructType.fromDDL(RATES)).groupBy("start").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_labelled").alias("n"), F.sum("n_positive").alias("p"), F.sum("n_late").alias("n_late")
    )
    return sums.select("start", (F.col("p") / F.nullif("n", F.lit(0))).alias("rate"), "n_rows", "n_late")


# --------------------------------------------------------------------------- copies


def deliveries(transactions: DataFrame, within: str = "1 hour") -> DataFrame:
    """Times that every key was delivered, by ``within`` of event time; state ends with the watermark.

    Copies of a transaction carry its time, so they meet in one window. What is delivered after
    the watermark has passed the window is not counted.
    """
    stamped = transactions.withColumn("_at", event_clock()).withWatermark("_at", within)
    counts = stamped.groupBy(F.window("_at", within).alias("w"), S.KEY).agg(
        F.count(F.lit(1)).alias("n"), F.min(S.TIME).alias(S.TIME), F.min(S.AMOUNT).alias(S.AMOUNT)
    )
    return counts.select(S.KEY, F.col("w.start").alias("start"), S.TIME, S.AMOUNT, "n")


def delivery_stream(transactions: DataFrame, root: str, checkpoint: str, within: str = "1 hour") -> StreamingQuery:
    """Changed delivery counts of each micro-batch in a ledger; :func:`first_copies` reads them."""
    ledger = Ledger(transactions.sparkSession, root)
    return _run(deliveries(transactions, within), lambda batch, number: ledger.commit(number, batch), checkpoint, "update")


def first_copies(spark: SparkSession, root: str, shape: T.StructType) -> DataFrame:
    """One row per delivered key and window, with the number of copies removed."""
    newest = latest(Ledger(spark, root).read(shape), [S.KEY, "start"])
    return newest.select(S.KEY, S.TIME, S.AMOUNT, (F.col("n") - 1).alias("n_removed"))
