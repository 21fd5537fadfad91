"""Publish confirmations: attempts joined with the confirmations that the broker sends.

The producer waits up to ten seconds for the confirmation of a message; without one
the attempt is an error.  Both sides are streams with a watermark.  The join has the
message's number as key and the waiting time as a range, so Spark keeps an attempt
only until its time is over on both watermarks, and a confirmation as long; an
attempt whose time passes unmatched comes out with no confirmation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.streaming.ingest import state_partitions, trigger_options

WAIT_SECONDS = 10  # fixed value: how long the producer waits


def confirmed_attempts(attempts: DataFrame, confirmations: DataFrame, wait_seconds: int = WAIT_SECONDS,
                       lateness: str = "1 hour") -> DataFrame:
    """`attempts` (run_id, seq, ts) with `ok`: a confirmation (seq, confirmed_at) came
    no earlier than the attempt and no later than `wait_seconds` after it.  Several
    confirmations of one attempt give a row each."""
    a, c = attempts.select("run_id", "seq", "ts"), confirmations.select(F.col("seq").alias("_seq"), "confirmed_at")
    if attempts.isStreaming:
        a, c = a.withWatermark("ts", lateness), c.withWatermark("confirmed_at", lateness)
    in_time = (F.col("confirmed_at") >= F.col("ts")) & (
        F.col("confirmed_at") <= F.col("ts") + F.expr(f"INTERVAL {wait_seconds} SECONDS"))
    joined = a.join(c, (F.col("seq") == F.col("_seq")) & in_time, "left_outer")
    return joined.select("run_id", "seq", "ts", F.col("_seq").isNotNull().alias("ok"))


def start_confirmed(attempts: DataFrame, confirmations: DataFrame, path: str, checkpoint: str,
                    wait_seconds: int = WAIT_SECONDS, lateness: str = "1 hour", available_now: bool = False,
                    interval: str | None = None, partitions: int | None = None) -> StreamingQuery:
    """Append every decided attempt to parquet files at `path`: the input of the run statistics."""
    with state_partitions(attempts.sparkSession, partitions):
        return (confirmed_attempts(attempts, confirmations, wait_seconds, lateness).writeStream.format("parquet")
                .option("path", path).option("checkpointLocation", checkpoint)
                .trigger(**trigger_options(available_now, interval)).start())
