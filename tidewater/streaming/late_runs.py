"""Streaming run statistics for attempts that arrive late and out of order.

Two keyed-state operators in one query, both with their state in Spark's state
store:

* `SlotBuffer`, keyed by a bucket of runs and a time slot, holds the attempts of a
  slot in list state.  An event-time timer fires once the watermark has passed the
  slot's end; the slot is then sorted by (run, ts, seq), summarised into one piece
  of the streak scan (`operators.runs`) for each run and forgotten.  A run that holds
  a third of all attempts is spread over its slots; what waits is bounded by the
  lateness plus a slot.  Buckets of runs keep the calls to the store few.
* `RunTotals`, keyed by run, folds the pieces into eight counters of value state.
  Slots close in order, so pieces arrive in order and no earlier state is read again.

An attempt whose slot has closed would change counted history.  It is set aside as
`late`, one without a run, number, time or outcome as `missing_field`: nothing is
dropped, counted + set aside = arrived (`attempt_balance`).  An attempt older than
the watermark whose slot is still open counts.

An attempt with a time and nothing else is a heartbeat: it moves the watermark, so
slots close while a source is silent, and is left out otherwise.

Both results go to one folder through Spark's file sink (exactly once by its log):
`kind=stats` (a run's counters whenever its slots close) and `kind=rejected`.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidewater.operators.keyed import latest_per_key
from tidewater.operators.runs import PIECE, _summarise, combine, finish
from tidewater.streaming.ingest import column_families, state_partitions, trigger_options

# as in operators.runs: tasks carry these functions, executors need no package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PIECE_COLUMNS = ", ".join(f"{c} {'boolean' if c == 'hit' else 'long'}" for c in PIECE)
# No column is ever null: pandas would turn a batch of whole numbers with a null into
# floats.  `missing` has a bit for each field of a rejected attempt that was null.
ROWS = ("kind string, deal long, run_id long, slot long, seq long, ts_us long, ok boolean, missing int, reason string, "
        + _PIECE_COLUMNS)
_KINDS = dict(c.split() for c in ROWS.split(", "))
_COLUMNS = list(_KINDS)
_FIELDS = ("run_id", "seq", "ts", "ok")
_EMPTY = {"string": "", "boolean": False}
NO_SLOT = -(1 << 62)  # the slot of attempts that lack a field
RUN_BUCKETS = 64  # buckets that a slot's runs are dealt to; more for more runs


def _frame(rows: dict, n: int) -> pd.DataFrame:
    """A frame of all ROWS columns; those not given are empty (0, false, '')."""
    return pd.DataFrame({c: rows.get(c, [_EMPTY.get(kind, 0)] * n) for c, kind in _KINDS.items()})


class SlotBuffer(StatefulProcessor):
    """Attempts of one (bucket of runs, slot) wait until the watermark passes the slot's end."""

    def __init__(self, slot_seconds: int, limit: int):
        self.slot_ms, self.limit = slot_seconds * 1000, limit

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "run_id long, ts_us long, seq long, ok boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        end = None if key[1] == NO_SLOT else (int(key[1]) + 1) * self.slot_ms
        now = timerValues.getCurrentWatermarkInMs()
        reason = "missing_field" if end is None else "late" if end <= now else None
        for part in rows:
            if reason is None:
                self.waiting.appendList(list(zip(*(part[c].tolist() for c in ("run_id", "ts_us", "seq", "ok")))))
                continue
            out = _frame({c: part[c].to_numpy() for c in ("deal", "run_id", "seq", "ts_us", "ok", "missing")}, len(part))
            yield self._stamped(out.assign(kind="rejected", reason=reason), now)
        if reason is None:
            self.handle.registerTimer(end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        run, ts, seq, ok = (np.array(x) for x in zip(*self.waiting.get()))
        self.waiting.clear()
        order = np.lexsort((seq, ts, run))
        pieces = _summarise(run[order], ok[order], ts[order], seq[order], self.limit)
        out = _frame({c: pieces[c].to_numpy() for c in ["run_id", *PIECE]}, len(pieces))
        out = out.assign(kind="piece", deal=out["run_id"], slot=int(key[1]))
        yield self._stamped(out, timerValues.getCurrentWatermarkInMs())

    @staticmethod
    def _stamped(out: pd.DataFrame, watermark: int) -> pd.DataFrame:
        """Rows leave just after the watermark, as the next operator demands."""
        return out.assign(left_at=pd.Timestamp(max(watermark, 0) + 1, unit="ms"))

    def close(self) -> None:
        pass


class RunTotals(StatefulProcessor):
    """One run's counters; rejected attempts pass through."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle) -> None:
        self.total = handle.getValueState("total", _PIECE_COLUMNS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pieces = []
        for part in rows:
            is_piece = (part["kind"] == "piece").to_numpy(bool)
            if not is_piece.all():
                yield part.loc[~is_piece, _COLUMNS]
            pieces += part.loc[is_piece, ["slot", *PIECE]].to_dict("records")
        if not pieces:
            return
        pieces.sort(key=lambda p: p["slot"])  # slots that closed in one batch
        slot = pieces[-1]["slot"]
        if self.total.exists():
            pieces.insert(0, dict(zip(PIECE, self.total.get())))
        total = {**pieces[0], "run_id": key[0]}
        for piece in pieces[1:]:
            total = combine(total, piece, self.limit)
        total = {c: bool(total[c]) if c == "hit" else int(total[c]) for c in PIECE}
        self.total.update(tuple(total.values()))
        yield _frame({**{c: [v] for c, v in total.items()}, "kind": ["stats"], "deal": [key[0]], "run_id": [key[0]], "slot": [int(slot)]}, 1)

    def close(self) -> None:
        pass


def start_late_run_stats(attempts: DataFrame, path: str, checkpoint: str, max_errors: int, slot_seconds: int = 3600,
                         lateness: str = "1 day", available_now: bool = False, interval: str | None = None,
                         partitions: int | None = None, buckets: int = RUN_BUCKETS) -> StreamingQuery:
    """Start the query over a stream of attempts (`run_id, seq, ts, ok`)."""
    lacks = [F.col(c).isNull() for c in _FIELDS]
    missing = sum((F.when(x, 1 << k).otherwise(0) for k, x in enumerate(lacks)), F.lit(0))
    # names the watermark's column in every part, else it is pushed below the watermark
    heartbeat = lacks[0] & lacks[1] & lacks[3] & ~lacks[2]
    timed = (attempts.withWatermark("ts", lateness)
             .observe("attempts", F.count(F.when(~heartbeat, 1)).alias("arrived"), F.count(F.when(heartbeat, 1)).alias("heartbeats"))
             .where(F.col("ts").isNull() | ~heartbeat))
    slot = F.floor(F.unix_seconds("ts") / slot_seconds).cast("long")
    zero = lambda c, absent=0: F.coalesce(c, F.lit(absent))
    dealt = timed.select(
        F.pmod(F.when(F.col("run_id").isNull(), F.xxhash64("seq", "ts")).otherwise(F.xxhash64("run_id")), F.lit(buckets)).alias("deal"),
        zero("run_id").alias("run_id"), zero("seq").alias("seq"), zero(F.unix_micros("ts")).alias("ts_us"),
        zero("ok", False).alias("ok"), missing.cast("int").alias("missing"),
        F.when(missing == 0, slot).otherwise(F.lit(NO_SLOT)).alias("slot"))
    slots = dealt.groupBy("deal", "slot").transformWithStateInPandas(
        SlotBuffer(slot_seconds, max_errors), f"{ROWS}, left_at timestamp", "append", "eventtime", eventTimeColumnName="left_at")
    totals = slots.groupBy("deal").transformWithStateInPandas(RunTotals(max_errors), ROWS, "append", "none")
    with state_partitions(attempts.sparkSession, partitions), column_families(attempts.sparkSession):
        return (totals.drop("deal").writeStream.format("parquet").partitionBy("kind").option("path", path)
                .option("checkpointLocation", checkpoint).trigger(**trigger_options(available_now, interval)).start())


def heartbeats(spark: SparkSession, at: list) -> DataFrame:
    """Attempts that only carry a time."""
    return spark.createDataFrame([(None, None, t, None) for t in at], "run_id long, seq long, ts timestamp, ok boolean")


def _results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(", ".join(f"{c} {t}" for c, t in _KINDS.items() if c != "deal")).parquet(path)


def late_run_stats_view(spark: SparkSession, path: str, max_errors: int) -> DataFrame:
    """Per run, as of its last closed slot: the columns of `operators.runs.run_stats`."""
    stats = _results(spark, path).where("kind = 'stats'").select("run_id", "slot", *PIECE)
    return finish(latest_per_key(stats, "run_id", ["slot"]), max_errors)


def rejected_attempts(spark: SparkSession, path: str) -> DataFrame:
    """Attempts set aside, as they came, with the reason."""
    rows = _results(spark, path).where("kind = 'rejected'").withColumn("ts", F.timestamp_micros("ts_us"))
    return rows.select(*[F.when(F.col("missing").bitwiseAND(1 << k) == 0, F.col(c)).alias(c) for k, c in enumerate(_FIELDS)],
                       "reason")


def attempt_balance(arrived: DataFrame, path: str) -> DataFrame:
    """One row: arrived = counted + late + missing_field + waiting (slots still open)."""
    spark = arrived.sparkSession
    some = F.coalesce(*[F.col(c).cast("string") for c in ("run_id", "seq", "ok")]).isNotNull() | F.col("ts").isNull()
    n_in = arrived.where(some).agg(F.count(F.lit(1)).alias("arrived"))
    last = latest_per_key(_results(spark, path).where("kind = 'stats'").select("run_id", "slot", "n_ok", "n_err"), "run_id", ["slot"])
    counted = last.agg(F.coalesce(F.sum(F.col("n_ok") + F.col("n_err")), F.lit(0)).alias("counted"))
    aside = rejected_attempts(spark, path).agg(
        F.count(F.when(F.col("reason") == "late", 1)).alias("late"),
        F.count(F.when(F.col("reason") == "missing_field", 1)).alias("missing_field"))
    one = n_in.join(counted).join(aside)  # single rows
    return one.withColumn("waiting", F.expr("arrived - counted - late - missing_field"))
