"""Streaming de-duplication of messages by their derived id.

A producer that retries, or a topic that is replayed, delivers a message more than
once.  The id derived from the source coordinates is equal for all copies, so Spark's
`dropDuplicatesWithinWatermark` keeps one id per message in the state store until
the watermark is `lateness` past it: state is bounded by the messages of that time
and not by the topic.  A copy that comes later still is older than the watermark and
is dropped as late.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.ids import derived_id
from tidewater.streaming.ingest import state_partitions, trigger_options

COORDINATES = ("topic", "partition", "offset")


def deduplicated(envelopes: DataFrame, lateness: str = "1 hour", parts: Sequence[str] = COORDINATES) -> DataFrame:
    """`envelopes` with `message_id`, each message once; batch or streaming input."""
    known = envelopes.withColumn("message_id", derived_id(*parts))
    if not envelopes.isStreaming:
        return known.dropDuplicates(["message_id"])
    return known.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["message_id"])


def start_dedup(envelopes: DataFrame, path: str, checkpoint: str, lateness: str = "1 hour",
                available_now: bool = False, interval: str | None = None, partitions: int | None = None) -> StreamingQuery:
    """Write each message once to parquet files at `path` (exactly once by the sink's log)."""
    with state_partitions(envelopes.sparkSession, partitions):
        return (deduplicated(envelopes, lateness).writeStream.format("parquet").option("path", path)
                .option("checkpointLocation", checkpoint).trigger(**trigger_options(available_now, interval)).start())


def dropped_as_late(query: StreamingQuery) -> int:
    """Rows that a query's stateful operators dropped because the watermark had passed them."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p["stateOperators"])
