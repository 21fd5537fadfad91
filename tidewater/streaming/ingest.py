"""The ingest query: envelopes -> one-pass decode -> keyed table + dead
letters, through `foreachBatch`.

Replay safety: the checkpoint records which offsets each batch covered; a
batch that failed after writing is re-run on restart with the same input,
and `KeyedTable.upsert` plus the per-batch dead-letter overwrite make the
re-run harmless.  Record ids must not be random for the same reason
(`functions.ids.derived_id`).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewater.operators.decode import decode_envelope
from tidewater.schemas import ENVELOPE_COORDS, USER_REQUIRED, USER_V1
from tidewater.sinks.keyed_table import KeyedTable, write_split, writer_of


@contextmanager
def state_partitions(spark, n: int | None):
    """Shuffle partitions for the stateful operators of a query started in
    this block.  A streaming query copies the session's settings when it
    starts and keeps its state partition count in the checkpoint from then
    on, so the setting is applied around `start()` and restored after."""
    if not n:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


@contextmanager
def column_families(spark):
    """A state store fit for `transformWithState`, for queries started in this
    block.  Spark's default provider keeps one column family a store and such a
    query fails on it; RocksDB takes its place, any other choice of the session
    stays.  A restart takes the provider from the checkpoint."""
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    if old.rsplit(".", 1)[-1] != "HDFSBackedStateStoreProvider":
        yield
        return
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def trigger_options(available_now: bool = False, interval: str | None = None) -> dict:
    if available_now:
        return {"availableNow": True}
    if interval:
        return {"processingTime": interval}
    return {"processingTime": "0 seconds"}  # Spark's default: next batch as soon as the last one ends


def start_ingest(envelopes: DataFrame, table: KeyedTable, dead_letter_path: str,
                 checkpoint: str, schema: StructType = USER_V1,
                 required=USER_REQUIRED, available_now: bool = False,
                 interval: str | None = None, compact_every: int | None = None) -> StreamingQuery:
    """`compact_every=n` folds the segments into a new base after every n-th
    batch, so reads of the table scan one base plus at most n segments."""
    decoded = decode_envelope(envelopes, schema, required)
    columns = [*[c for c in ENVELOPE_COORDS if c in envelopes.columns],
               *[f.name for f in schema.fields]]

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        write_split(batch, table, dead_letter_path, batch_id, columns, writer_of(checkpoint))
        if compact_every and (batch_id + 1) % compact_every == 0:
            table.compact()

    return (
        decoded.writeStream.outputMode("append")
        .foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(available_now, interval))
        .start()
    )
