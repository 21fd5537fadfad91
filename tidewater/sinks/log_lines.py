"""JSON log lines as a DataFrame sink: one text line per record."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_log_lines(lines: DataFrame, path: str, column: str = "value") -> None:
    lines.select(column).write.mode("append").text(path)


def stream_log_lines(lines: DataFrame, path: str, checkpoint: str, column: str = "value"):
    return (lines.select(column).writeStream.format("text").option("path", path)
            .option("checkpointLocation", checkpoint).start())
