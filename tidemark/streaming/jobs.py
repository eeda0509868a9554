"""Structured Streaming jobs: scoring, rate monitoring, duplicate guard."""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schema as S
from tidemark.functions.scalars import week_index
from tidemark.plans.scoring import score_checked
from tidemark.plans.training import Bundle
from tidemark.sources.tables import EPOCH


def score_stream(records: DataFrame, bundle: Bundle, out: str, checkpoint: str) -> StreamingQuery:
    """Score a stream of records into ``out/scored``; bad ones go to ``out/quarantine``.

    Each micro-batch overwrites its own folder, so a replayed batch changes nothing.
    The plan is the batch plan, and it keeps no state.
    """

    def sink(batch: DataFrame, number: int) -> None:
        scored, quarantined = score_checked(batch, bundle)
        folder = f"batch={number}"
        scored.write.mode("overwrite").parquet(posixpath.join(out, "scored", folder))
        quarantined.write.mode("overwrite").parquet(posixpath.join(out, "quarantine", folder))

    return (
        records.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def event_clock() -> Column:
    """Event time of a transaction, independent of the session time zone."""
    return F.timestamp_seconds(F.unix_timestamp(F.lit(EPOCH + "+00:00").cast("timestamp")) + F.col(S.TIME))


# Windows are aligned to 1970-01-01, a Thursday; the clock starts on a Monday.
WINDOW_START = "4 days"


def windowed_rate(transactions: DataFrame, period: str = "7 days", late: str = "1 day") -> DataFrame:
    """Rate and volume per event-time window; rows later than ``late`` are dropped.

    Windows start where the transaction clock starts, so a seven-day window is a week
    index of the batch report. State holds one row per open window.
    """
    stamped = transactions.withColumn("_at", event_clock()).withWatermark("_at", late)
    return (
        stamped.groupBy(F.window("_at", period, startTime=WINDOW_START).alias("w"))
        .agg(F.avg(F.col(S.LABEL).cast("double")).alias("rate"), F.count(S.LABEL).alias("n_rows"))
        .select(F.col("w.start").alias("start"), "rate", "n_rows")
    )


def week_of(start: Column) -> Column:
    """Week index of a window's start."""
    epoch = F.unix_timestamp(F.lit(EPOCH + "+00:00").cast("timestamp"))
    return week_index(F.unix_timestamp(start) - epoch)


def update_stream(updates: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch's changed rows; :func:`latest` keeps the newest per key."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(posixpath.join(out, f"batch={number}"))

    return (
        updates.writeStream.outputMode("update").foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Newest version of every row of an update log partitioned by ``batch``."""
    values = [c for c in changes.columns if c not in (*keys, "batch")]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return newest.select(*keys, "v.*")


def without_duplicates(transactions: DataFrame, within: str = "1 hour") -> DataFrame:
    """First copy of every key; copies arriving within the delay are dropped.

    Keys are forgotten once the watermark has passed them, so state stays bounded.
    """
    return (
        transactions.withColumn("_at", event_clock())
        .withWatermark("_at", within)
        .dropDuplicatesWithinWatermark([S.KEY])
        .drop("_at")
    )


def append_stream(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finish(query: StreamingQuery, seconds: float | None = None) -> None:
    """Wait for an ``availableNow`` run, for as long as it takes unless the caller sets a limit.

    A run that passes the caller's limit is stopped and reported.
    """
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream did not finish within {seconds} s")
