"""Streaming run statistics.

Each micro-batch is summarised with the same distributed scan as the batch
operator (`operators.runs.streak_summaries`).  The stored summary of each run
touched by the batch is taken as one earlier piece (`pid = -1`), the pieces
are folded, and the new summaries are upserted into a keyed state table
(key `run_id`, later batch wins).  State per run is eight counters; a hot
run is still split across partitions within each batch.

Attempts of one run must arrive in order across batches (a later batch
holds later attempts), as they do when a producer appends them; where they do
not, `streaming.late_runs` keeps them in Spark's state store until their time.

The state also keeps each run's last `(ts, seq)`; a batch holding an
attempt that is not after it fails with `OutOfOrderAttempts` rather than
folding it into a wrong streak.

Folds are numbered over all checkpoints of a state table.  A state row holds
its fold number, and the commit log names the checkpoint and its batch beside
it.  A batch that was not folded yet starts from the last committed state, of
whichever checkpoint, and takes the next number.  A replay takes the number it
had and folds onto the state as it was before (`KeyedTable.snapshot(before=n)`),
so a batch re-run after a crash that followed its state write does not count
its attempts twice.  Checkpoints may follow each other or take turns; two that
fold at the same moment take the same number, which the next fold and the view
report as `ConcurrentFolds`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.operators.runs import PIECE, finish, fold, streak_summaries
from tidewater.sinks.keyed_table import KeyedTable, writer_of
from tidewater.streaming.ingest import trigger_options


class OutOfOrderAttempts(ValueError):
    """A micro-batch holds attempts older than ones already folded."""


class ConcurrentFolds(RuntimeError):
    """Two batches were folded onto the same state at the same time."""


def run_state_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, key="run_id", order=["batch"], history=True)


def _folds(state: KeyedTable) -> dict[int, str]:
    """Fold number -> the writer and batch that made it."""
    folds: dict[int, str] = {}
    for number, by in state.written():
        if folds.setdefault(number, by) != by:
            raise ConcurrentFolds(f"fold {number} of {state.path} was written by {folds[number]} and by {by}")
    return folds


def fold_batch(batch: DataFrame, batch_id: int, state: KeyedTable, max_errors: int, writer: str = "") -> None:
    by = f"{writer}/{int(batch_id)}"
    folds = _folds(state)
    number = next((n for n, who in folds.items() if who == by), max(folds, default=-1) + 1)
    new = streak_summaries(batch, max_errors).persist()
    try:
        pieces = new
        before = state.snapshot(before=number)
        if before is not None:
            # Each run's first attempt in this batch, from the scan's pieces.
            firsts = new.groupBy("run_id").agg(
                F.min_by(F.struct("first_ts", "first_seq"), "pid").alias("_first"))
            prev = before.join(firsts, "run_id", "left_semi")
            seen = prev.select("run_id", F.struct("last_ts", "last_seq").alias("_seen"))
            late = firsts.join(seen, "run_id").where(F.col("_first") <= F.col("_seen"))
            bad = late.select("run_id").limit(5).collect()
            if bad:
                raise OutOfOrderAttempts(
                    f"batch {batch_id}: runs {[r.run_id for r in bad]} received attempts "
                    "not after ones already counted")
            pieces = new.unionByName(prev.select(F.lit(-1).alias("pid"), "run_id", *PIECE))
        folded = fold(pieces, max_errors).withColumn("batch", F.lit(number).cast("long"))
        state.upsert(folded, number, by)
    finally:
        new.unpersist()


def start_run_stats(attempts: DataFrame, state: KeyedTable, checkpoint: str,
                    max_errors: int, available_now: bool = False) -> StreamingQuery:
    return (
        attempts.writeStream.foreachBatch(
            lambda df, batch_id: fold_batch(df, batch_id, state, max_errors, writer_of(checkpoint)))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(available_now))
        .start()
    )


def run_stats_view(state: KeyedTable, max_errors: int) -> DataFrame:
    _folds(state)
    return finish(state.current(), max_errors)
