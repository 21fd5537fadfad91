"""Per-run attempt statistics with the producer's two cut-offs.

A producer run tries to fetch and publish again and again.  Its rules:

* `messages_sent` counts successful attempts, `errors` failed ones;
* a run stops once `max_errors` consecutive attempts have failed (the check
  is made before each attempt, so the failure that reaches the limit is
  counted and nothing after it is; a success resets the streak, not the
  totals);
* a run stops at `start + duration` (half-open: an attempt exactly at the
  end is not made).

Input: an attempts DataFrame `run_id, seq, ts, ok` (see `schemas.ATTEMPTS`),
ordered within a run by `(ts, seq)`.

The streak cut-off is a prefix scan along each run.  A window partitioned
by run would sort a run that holds a third of all rows in one task, so the
scan is distributed instead:

1. range-partition by `(run_id, ts, seq)`: a hot run spans many partitions,
   in order;
2. one vectorised pass per partition (`mapInPandas`) emits, per run in that
   partition, a summary of a few counters;
3. the summaries (at most one per run per partition) are combined in order
   with window functions, which gives each piece the streak it inherits,
   hence the first point where the limit is reached.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The per-partition scan below runs in Python workers.  Pickle this module's
# functions by value so the tasks carry them: executors then need only
# numpy and pandas, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


SUMMARY_SCHEMA = (
    "pid int, run_id long, n_ok long, n_err long, lead long, trail long, "
    "max_streak long, hit boolean, ok_upto long, err_upto long, "
    "first_ts long, first_seq long, last_ts long, last_seq long"
)
_FIELDS = ["n_ok", "n_err", "lead", "trail", "max_streak", "hit", "ok_upto", "err_upto"]
# First and last attempt of a piece (ts as epoch microseconds): not part of
# the streak arithmetic, carried so a stream can check arrival order.
_EDGES = ["first_ts", "first_seq", "last_ts", "last_seq"]
PIECE = [*_FIELDS, *_EDGES]


# --- per-partition scan (runs inside a task, vectorised with numpy) --------
def _summarise(run: np.ndarray, ok: np.ndarray, ts: np.ndarray, seq: np.ndarray,
               limit: int) -> pd.DataFrame:
    """Summaries of each maximal same-run segment of one sorted batch."""
    n = len(run)
    idx = np.arange(n)
    start = np.ones(n, dtype=bool)
    start[1:] = run[1:] != run[:-1]
    seg = np.cumsum(start) - 1
    seg_start = np.flatnonzero(start)
    seg_end = np.append(seg_start[1:], n) - 1
    # Position of the last success at or before each row, or segment start - 1.
    marker = np.where(ok, idx, -1)
    marker = np.maximum(marker, np.where(start, idx - 1, -1))
    streak = idx - np.maximum.accumulate(marker)
    okc = np.cumsum(ok)
    ok_before_seg = np.where(seg_start > 0, okc[seg_start - 1], 0)
    n_seg = seg_end - seg_start + 1
    n_ok = okc[seg_end] - ok_before_seg
    # Leading errors: up to the first success in the segment.
    first_ok = np.full(len(seg_start), -1)
    ok_rows = np.flatnonzero(ok)
    if len(ok_rows):
        s_of_ok = seg[ok_rows]
        uniq, first = np.unique(s_of_ok, return_index=True)
        first_ok[uniq] = ok_rows[first]
    lead = np.where(first_ok >= 0, first_ok - seg_start, n_seg)
    trail = streak[seg_end]
    max_streak = np.maximum.reduceat(streak, seg_start)
    hit_rows = np.flatnonzero(streak == limit)
    hit = np.zeros(len(seg_start), dtype=bool)
    ok_upto = np.zeros(len(seg_start), dtype=np.int64)
    err_upto = np.zeros(len(seg_start), dtype=np.int64)
    if len(hit_rows):
        s_of_hit = seg[hit_rows]
        uniq, first = np.unique(s_of_hit, return_index=True)
        rows = hit_rows[first]
        hit[uniq] = True
        ok_upto[uniq] = okc[rows] - ok_before_seg[uniq]
        err_upto[uniq] = (rows - seg_start[uniq] + 1) - ok_upto[uniq]
    return pd.DataFrame({
        "run_id": run[seg_start], "n_ok": n_ok, "n_err": n_seg - n_ok, "lead": lead,
        "trail": trail, "max_streak": max_streak, "hit": hit,
        "ok_upto": ok_upto, "err_upto": err_upto,
        "first_ts": ts[seg_start], "first_seq": seq[seg_start],
        "last_ts": ts[seg_end], "last_seq": seq[seg_end],
    })


def combine(a: dict, b: dict, limit: int) -> dict:
    """Summary of piece `a` followed by piece `b` of the same run."""
    a_all = a["n_ok"] == 0
    b_all = b["n_ok"] == 0
    out = {
        "run_id": a["run_id"],
        "n_ok": a["n_ok"] + b["n_ok"],
        "n_err": a["n_err"] + b["n_err"],
        "lead": a["lead"] + b["lead"] if a_all else a["lead"],
        "trail": a["trail"] + b["trail"] if b_all else b["trail"],
        "max_streak": max(a["max_streak"], b["max_streak"], a["trail"] + b["lead"]),
        "first_ts": a["first_ts"], "first_seq": a["first_seq"],
        "last_ts": b["last_ts"], "last_seq": b["last_seq"],
    }
    if a["hit"]:
        out.update(hit=True, ok_upto=a["ok_upto"], err_upto=a["err_upto"])
    elif a["trail"] + b["lead"] >= limit:
        out.update(hit=True, ok_upto=a["n_ok"], err_upto=a["n_err"] + limit - a["trail"])
    elif b["hit"]:
        out.update(hit=True, ok_upto=a["n_ok"] + b["ok_upto"], err_upto=a["n_err"] + b["err_upto"])
    else:
        out.update(hit=False, ok_upto=0, err_upto=0)
    return out


def _partition_summaries(limit: int):
    """Per task: summaries of each run in the task's sorted rows.  Only the
    last run of an Arrow batch can continue into the next batch, so only
    that one is carried (as a dict); the rest pass through as frames."""
    cols = ["run_id", *PIECE]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending = None  # summary of the run still open at the batch edge
        pid = None
        out: list[pd.DataFrame] = []
        size = 0
        for pdf in batches:
            if pdf.empty:
                continue
            pid = int(pdf["pid"].iat[0])
            s = _summarise(pdf["run_id"].to_numpy(np.int64), pdf["ok"].to_numpy(bool),
                           pdf["ts_us"].to_numpy(np.int64), pdf["seq"].to_numpy(np.int64), limit)
            head = s.iloc[0].to_dict()
            if pending is not None:
                if head["run_id"] == pending["run_id"]:
                    s.iloc[0] = pd.Series(combine(pending, head, limit))[cols]
                else:
                    out.append(pd.DataFrame([pending], columns=cols))
            pending = s.iloc[-1].to_dict()
            if len(s) > 1:
                out.append(s.iloc[:-1])
                size += len(s) - 1
            if size >= 10_000:
                yield pd.concat(out, ignore_index=True).assign(pid=pid)
                out, size = [], 0
        if pending is not None:
            out.append(pd.DataFrame([pending], columns=cols))
        if out:
            yield pd.concat(out, ignore_index=True).assign(pid=pid)
    return scan


# --- the operators ---------------------------------------------------------
def streak_summaries(attempts: DataFrame, max_errors: int, partitions: int | None = None) -> DataFrame:
    """Step 1-2: one summary row per (partition, run).  Attempts that lack the
    run, the time, the number or the outcome have no place in a run's order
    and are left out."""
    spark = attempts.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        attempts.select("run_id", "ts", "seq", F.col("ok").cast("boolean").alias("ok")).dropna()
        .repartitionByRange(n, "run_id", "ts", "seq")
        .sortWithinPartitions("run_id", "ts", "seq")
        .select(F.spark_partition_id().alias("pid"), "run_id", "ok",
                F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "seq")
    )
    return ordered.mapInPandas(_partition_summaries(max_errors), SUMMARY_SCHEMA)


def fold(summaries: DataFrame, max_errors: int) -> DataFrame:
    """Combine the ordered pieces of each run (`pid` order) into one summary
    per run with the same columns (`pid` dropped).  Runs as window
    functions over at most one row per run per piece."""
    w = Window.partitionBy("run_id").orderBy("pid")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    s = summaries.withColumn("n", F.col("n_ok") + F.col("n_err"))
    s = s.withColumn("cum_n", F.sum("n").over(upto))
    cum_before = F.coalesce(F.sum("n").over(before), F.lit(0))
    # Last earlier piece that contains a success: the streak restarts there.
    brk = F.last(
        F.when(F.col("n_ok") > 0, F.struct(F.col("cum_n").alias("c"), F.col("trail").alias("t"))),
        ignorenulls=True,
    ).over(before)
    s = s.withColumn("_cb", cum_before).withColumn("_brk", brk)
    s = s.withColumn(
        "carry",
        F.when(F.col("_brk").isNull(), F.col("_cb"))
        .otherwise(F.col("_brk.t") + F.col("_cb") - F.col("_brk.c")),
    )
    carry, lead, lim = F.col("carry"), F.col("lead"), F.lit(max_errors)
    reach = carry + lead >= lim
    s = s.select(
        "run_id", "pid", "n_ok", "n_err", "n", "lead", "_cb", *_EDGES,
        (reach | F.col("hit")).alias("hit_here"),
        F.when(reach, F.lit(0)).otherwise(F.col("ok_upto")).alias("ok_to"),
        F.when(reach, F.greatest(lim - carry, F.lit(0))).otherwise(F.col("err_upto")).alias("err_to"),
        F.greatest(F.col("max_streak"), carry + lead).alias("streak"),
        F.when(F.col("n_ok") > 0, F.col("trail")).otherwise(carry + F.col("n")).alias("carry_out"),
    )
    s = s.withColumn(
        "first_hit", F.min(F.when(F.col("hit_here"), F.col("pid"))).over(Window.partitionBy("run_id"))
    )
    before_hit = F.col("first_hit").isNull() | (F.col("pid") < F.col("first_hit"))
    at_hit = F.coalesce(F.col("pid") == F.col("first_hit"), F.lit(False))
    has_ok = F.col("n_ok") > 0
    return s.groupBy("run_id").agg(
        F.sum("n_ok").alias("n_ok"),
        F.sum("n_err").alias("n_err"),
        F.coalesce(F.min_by(F.when(has_ok, F.col("_cb") + F.col("lead")), F.when(has_ok, F.col("pid"))),
                   F.sum("n")).alias("lead"),
        F.max_by("carry_out", "pid").alias("trail"),
        F.max("streak").alias("max_streak"),
        F.max(at_hit).alias("hit"),
        F.sum(F.when(at_hit, F.col("ok_to")).when(before_hit, F.col("n_ok")).otherwise(0)).alias("ok_upto"),
        F.sum(F.when(at_hit, F.col("err_to")).when(before_hit, F.col("n_err")).otherwise(0)).alias("err_upto"),
        F.min_by(F.struct("first_ts", "first_seq"), "pid").alias("_first"),
        F.max_by(F.struct("last_ts", "last_seq"), "pid").alias("_last"),
    ).select("run_id", *_FIELDS, "_first.*", "_last.*")


def finish(folded: DataFrame, max_errors: int) -> DataFrame:
    """Per-run result from a folded summary."""
    hit = F.col("hit")
    return folded.select(
        "run_id",
        F.when(hit, F.col("ok_upto")).otherwise(F.col("n_ok")).cast("long").alias("messages_sent"),
        F.when(hit, F.col("err_upto")).otherwise(F.col("n_err")).cast("long").alias("errors"),
        F.when(hit, F.lit(max_errors)).otherwise(F.col("max_streak")).cast("long").alias("longest_streak"),
        hit.alias("stopped"),
    )


def run_stats(attempts: DataFrame, max_errors: int, partitions: int | None = None) -> DataFrame:
    """`run_id, messages_sent, errors, longest_streak, stopped` per run with
    at least one attempt, honouring the consecutive-error cut-off."""
    return finish(fold(streak_summaries(attempts, max_errors, partitions), max_errors), max_errors)


def within_duration(attempts: DataFrame, seconds: int, salts: int = 32) -> DataFrame:
    """Attempts made before `first attempt + seconds` of their run.

    The start of each run is a grouped min (partial aggregation absorbs a
    hot run) joined back on the run.  AQE broadcasts the starts when they turn
    out small.  Otherwise the join is dealt by the run and one of `salts`
    salts, so a hot run spreads over that many partitions; the starts, one
    row per run, are repeated for each salt.  Attempts without a run or a
    time are outside every duration.
    """
    starts = (attempts.groupBy("run_id").agg(F.min("ts").alias("_start"))
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    salted = attempts.withColumn("_salt", F.pmod(F.xxhash64("ts", "seq"), F.lit(salts)).cast("int"))
    joined = salted.join(starts, ["run_id", "_salt"])
    end = F.col("_start") + F.make_dt_interval(secs=F.lit(seconds))
    return joined.where(F.col("ts") < end).drop("_start", "_salt")


def attempts_from_events(events: DataFrame) -> DataFrame:
    """Events as producer attempts: run = user, error events are failures."""
    return events.select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("seq"),
        F.col("ts"),
        (F.col("event_type") != "error").alias("ok"),
    )
