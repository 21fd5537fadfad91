import json

from pyspark.sql import functions as F

from tidewater.functions.latency import format_latency
from tidewater.operators.logs import latency_summary, log_line, parse_logs
from tidewater.schemas import LOG_KEYS
from tidewater.sinks.log_lines import write_log_lines


def test_log_line_keys_defaults_and_roundtrip(spark, scratch):
    df = spark.createDataFrame(
        [("fetch", 0.1234, "INFO"), ("fetch", 0.5, "ERROR"), ("transform", 2.0, "INFO"),
         ("transform", None, "INFO")],
        "fn string, secs double, level string")
    lines = df.select(log_line({
        "function_name": F.col("fn"), "level": F.col("level"),
        "latency": F.when(F.col("secs").isNotNull(), format_latency("secs")).otherwise(F.lit("")),
    }).alias("value"))
    first = json.loads(lines.first()[0])
    assert list(first) == list(LOG_KEYS)
    assert first["status"] == "Success" and first["environment"] is None
    assert first["request_payload"] == {} and first["latency"] == "0.123s"

    write_log_lines(lines, f"{scratch}/logs")
    back = parse_logs(spark.read.text(f"{scratch}/logs"))
    got = {r.function_name: (r.calls, r.errors, r.max_latency, float(r.p50_latency))
           for r in latency_summary(back).collect()}
    assert got == {"fetch": (2, 1, 0.5, 0.3115), "transform": (1, 0, 2.0, 2.0)}
