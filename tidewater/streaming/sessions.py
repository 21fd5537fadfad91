"""Runs without a run id: attempts of one key with no longer pause than `gap`.

Spark's session windows merge attempts that lie within `gap` of each other, in any
order of arrival; a session is final, and leaves the state, once the watermark has
passed its end.  Counts are partial aggregates, merged window by window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.streaming.ingest import state_partitions, trigger_options


def attempt_sessions(attempts: DataFrame, gap: str, lateness: str = "1 day", key: str = "run_id") -> DataFrame:
    """key, started, last_attempt, attempts, messages_sent, errors of each session.
    Attempts without a key or a time are in no session."""
    timed = attempts.withWatermark("ts", lateness) if attempts.isStreaming else attempts
    # the condition names the watermark's column: below the watermark it would stop heartbeats
    timed = timed.where(F.col("ts").isNotNull() & (F.col(key).isNotNull() | F.col("ts").isNull()))
    out = timed.groupBy(key, F.session_window("ts", gap).alias("w")).agg(
        F.min("ts").alias("started"), F.max("ts").alias("last_attempt"), F.count(F.lit(1)).alias("attempts"),
        F.count(F.when(F.col("ok"), 1)).alias("messages_sent"), F.count(F.when(~F.col("ok"), 1)).alias("errors"))
    return out.select(key, "started", "last_attempt", "attempts", "messages_sent", "errors")


def start_sessions(attempts: DataFrame, path: str, checkpoint: str, gap: str, lateness: str = "1 day",
                   available_now: bool = False, interval: str | None = None, partitions: int | None = None) -> StreamingQuery:
    """Append every final session to parquet files at `path`."""
    with state_partitions(attempts.sparkSession, partitions):
        return (attempt_sessions(attempts, gap, lateness).writeStream.format("parquet").option("path", path)
                .option("checkpointLocation", checkpoint).trigger(**trigger_options(available_now, interval)).start())
