"""Streaming word count.

`complete` mode re-emits every word each batch and suits the console only.
At scale use `update` mode into a keyed table: each batch writes the words
whose count changed, keyed by word, and the newest count (the largest,
since counts only grow) wins.  The counts live in the state store
(RocksDB when configured), partitioned by word like the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidewater.operators.wordcount import word_counts
from tidewater.sinks.keyed_table import KeyedTable, writer_of
from tidewater.streaming.ingest import state_partitions, trigger_options


def start_word_count(lines: DataFrame, table: KeyedTable, checkpoint: str,
                     text_col: str = "value", available_now: bool = False,
                     compact_every: int | None = None,
                     partitions: int | None = None) -> StreamingQuery:
    """Each batch writes the words whose count changed; `compact_every=n`
    folds them into a new base every n batches so reads stay bounded.
    `partitions` sets the state partitions when the query first starts."""
    counts = word_counts(lines, text_col)

    def each_batch(df: DataFrame, batch_id: int) -> None:
        table.upsert(df, batch_id, writer_of(checkpoint))
        if compact_every and (batch_id + 1) % compact_every == 0:
            table.compact()

    with state_partitions(lines.sparkSession, partitions):
        return (
            counts.writeStream.outputMode("update")
            .foreachBatch(each_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger_options(available_now))
            .start()
        )


def start_word_count_complete(lines: DataFrame, path: str, checkpoint: str, text_col: str = "value",
                              available_now: bool = False, partitions: int | None = None) -> StreamingQuery:
    """Complete mode: every batch writes the whole result, which replaces the
    folder at `path`.  For a large vocabulary use `start_word_count`."""
    counts = word_counts(lines, text_col)
    with state_partitions(lines.sparkSession, partitions):
        return (
            counts.writeStream.outputMode("complete")
            .foreachBatch(lambda df, batch_id: df.write.mode("overwrite").parquet(path))
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger_options(available_now))
            .start()
        )


def word_count_table(spark, path: str) -> KeyedTable:
    return KeyedTable(spark, path, key="word", order=["count"])
