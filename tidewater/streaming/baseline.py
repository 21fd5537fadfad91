"""Daily anomaly scores against a baseline that grows with the stream.

A day is counted in a tumbling window and closes once the watermark has passed it.
It is then scored against the days before it only, from three sums per key in
Spark's state store (days, total, squares: whole numbers, so merging is exact), and
added to them.  No earlier day is read again.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidewater.operators.anomaly import streaming_daily_counts
from tidewater.streaming.ingest import column_families, state_partitions, trigger_options

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SQUARES = 1 << 62  # squares are kept as two whole numbers below this


def _z(n: int, days: int, total: int, squares: int) -> float:
    """Score of a day with `n` against the days summed up; NaN where they say nothing."""
    spread = days * squares - total * total
    if days < 2 or spread <= 0:
        return math.nan
    return float((n - Decimal(total) / days) / (Decimal(spread) / (days * (days - 1))).sqrt())


class Baseline(StatefulProcessor):
    """Sums over the closed days of one key."""

    def init(self, handle) -> None:
        self.sums = handle.getValueState("sums", "days long, total long, high long, low long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        days = pd.concat(list(rows)).sort_values("day")  # one row for each day that closed in this batch
        count = total = squares = 0
        if self.sums.exists():
            count, total, high, low = self.sums.get()
            squares = high * _SQUARES + low
        scores = []
        for n in days["n"].tolist():
            scores.append(_z(n, count, total, squares))
            count, total, squares = count + 1, total + n, squares + n * n
        self.sums.update((count, total, squares // _SQUARES, squares % _SQUARES))
        yield days.assign(score=scores)[["key", "day", "n", "score"]]

    def close(self) -> None:
        pass


def start_daily_scores(events: DataFrame, path: str, checkpoint: str, ts_col: str = "ts", key: str = "event_type",
                       lateness: str = "1 day", available_now: bool = False, interval: str | None = None,
                       partitions: int | None = None) -> StreamingQuery:
    """Append key, day, n, score of every closed day to parquet files at `path`."""
    counts = streaming_daily_counts(events, ts_col, key, lateness).select(F.col(key).alias("key"), "day", "n")
    scored = counts.groupBy("key").transformWithStateInPandas(Baseline(), "key string, day date, n long, score double",
                                                              "append", "none")
    with state_partitions(events.sparkSession, partitions), column_families(events.sparkSession):
        return (scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
                .trigger(**trigger_options(available_now, interval)).start())


def scores_view(scores: DataFrame, key: str = "event_type") -> DataFrame:
    """The written scores in the columns of `operators.anomaly.zscores`."""
    z = F.round(F.nanvl("score", F.lit(None).cast("double")), 6).cast("decimal(18,6)")
    return scores.select(F.col("key").alias(key), "day", "n", z.alias("z"))


def scored_days(counts: DataFrame, key: str = "event_type") -> DataFrame:
    """Batch form: each day against the earlier days of its key."""
    w = Window.partitionBy(key).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    sd = F.stddev_samp("n").over(w)
    z = F.when(sd > 0, (F.col("n") - F.avg("n").over(w)) / sd)
    return counts.select(key, "day", "n", F.round(z, 6).cast("decimal(18,6)").alias("z"))
