"""Daily volume per type with a z-score against that type's daily mean.

Counts come from a tumbling one-day window (the same expression serves a
streaming query with a watermark); the z-score step then works on one row
per type and day, so its window is small whatever the input size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_counts(df: DataFrame, ts_col: str, key: str) -> DataFrame:
    """Days of a TIMESTAMP_NTZ column are wall-clock days whatever the
    session time zone; a TIMESTAMP column is cut at midnight UTC."""
    ts = F.col(ts_col)
    return (
        df.groupBy(key, F.window(ts, "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(key, F.to_date(F.col("w.start")).alias("day"), "n")
    )


def utc_instant(ts_ntz: str) -> Column:
    """A TIMESTAMP_NTZ wall-clock value as the TIMESTAMP instant of that wall
    time in UTC, without going through the session time zone (a plain cast
    would).  Watermarks need TIMESTAMP; this keeps day windows on wall-clock
    days whatever the session zone."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                             F.col(ts_ntz))
    return F.timestamp_micros(micros)


def window_day(start: Column) -> Column:
    """UTC calendar day of a window start, independent of the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(start) / 86_400_000_000).cast("int"))


def streaming_daily_counts(events: DataFrame, ts_col: str = "ts", key: str = "event_type",
                           lateness: str = "1 day") -> DataFrame:
    """Tumbling one-day counts over a stream, with a watermark so state for
    days older than `lateness` behind the newest event is dropped."""
    return (
        events.select(key, utc_instant(ts_col).alias("_t"))
        .withWatermark("_t", lateness)
        .groupBy(key, F.window("_t", "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(key, window_day(F.col("w.start")).alias("day"), "n")
    )


def zscores(counts: DataFrame, key: str = "event_type") -> DataFrame:
    """z-score of each day's count against its key's daily mean."""
    w = Window.partitionBy(key)
    mean, sd = F.avg("n").over(w), F.stddev_samp("n").over(w)
    z = F.when(sd > 0, (F.col("n") - mean) / sd)
    return counts.select(key, "day", "n", F.round(z, 6).cast("decimal(18,6)").alias("z"))


def daily_zscores(df: DataFrame, ts_col: str = "ts", key: str = "event_type") -> DataFrame:
    return zscores(daily_counts(df, ts_col, key), key)
