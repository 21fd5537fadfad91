"""JSON log records: build, parse, and per-function latency summaries.

The logger writes one JSON object per line with 17 keys (`schemas.LOG_KEYS`);
four of them may hold any JSON and are read back as text.  Latency lines
carry `function_name` and `latency` such as `0.123s`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.codec import parse_fixed
from tidewater.functions.latency import latency_seconds
from tidewater.schemas import LOG, LOG_KEYS

# --- fixed values ------------------------------------------------------------
LOGGER_NAME = "[Subscriber Pipeline]"
LOG_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# ------------------------------------------------------------------------------


def log_line(fields: dict[str, Column]) -> Column:
    """One JSON log line; keys in the logger's order, missing keys get the
    logger's defaults, nulls are written as JSON null."""
    defaults = {
        "timestamp": F.date_format(F.current_timestamp(), LOG_TIME_FORMAT),
        "level": F.lit("INFO"), "item_id": F.lit(""), "message": F.lit(""),
        "user_id": F.lit(""), "conversation_session_id": F.lit(""), "platform": F.lit(""),
        "language": F.lit(""), "request_payload": F.create_map(),
        "response_payload": F.create_map(), "function_name": F.lit(""),
        "input_data": F.lit(""), "error_details": F.lit(""), "status": F.lit("Success"),
        "latency": F.lit(""), "environment": F.lit(None).cast("string"),
        "logger_name": F.lit(LOGGER_NAME),
    }
    cols = {**defaults, **fields}
    return F.to_json(F.struct(*[cols[k].alias(k) for k in LOG_KEYS]),
                     {"ignoreNullFields": "false"})


def parse_logs(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """17 string columns plus `latency_s` (double, null when absent)."""
    parsed = lines.select(parse_fixed(F.col(text_col), LOG, corrupt_column=None).alias("_l"))
    return parsed.select("_l.*").withColumn("latency_s", latency_seconds("latency"))


def latency_summary(logs: DataFrame, exact: bool = True) -> DataFrame:
    """Per function: calls, errors, average, max and median latency.

    The median is exact by default: `percentile` keeps one counter per
    distinct value, and latencies are written to the millisecond, so a
    group holds at most (max latency in ms) counters however many calls it
    has.  `exact=False` uses the mergeable `percentile_approx` sketch.
    """
    # No filter on `latency_s` before the aggregate: it would be pushed down
    # under the parse and evaluate it a second time.  The aggregates skip
    # null latencies themselves; functions without a timed call are dropped
    # after the aggregate, where the filter stays.
    lat = F.col("latency_s")
    p50 = F.percentile(lat, F.lit(0.5)) if exact else F.percentile_approx(lat, 0.5, 10_000)
    timed_error = (F.col("level") == "ERROR") & lat.isNotNull()
    return (
        logs.groupBy("function_name").agg(
            F.count(lat).alias("calls"),
            F.sum(F.when(timed_error, 1).otherwise(0)).cast("long").alias("errors"),
            F.round(F.avg(lat), 6).cast("decimal(18,6)").alias("avg_latency"),
            F.max(lat).alias("max_latency"),
            F.round(p50, 6).cast("decimal(18,6)").alias("p50_latency"),
        )
        .where(F.col("calls") > 0)
    )
