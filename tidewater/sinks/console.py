"""Console sink, for debugging a query by eye."""

from __future__ import annotations

from pyspark.sql import DataFrame


def to_console(df: DataFrame, output_mode: str = "complete", truncate: bool = False):
    """Complete mode re-prints the whole result each batch: fine for a demo,
    not for a large result (use update mode and a keyed table instead)."""
    return (df.writeStream.outputMode(output_mode).format("console")
            .option("truncate", str(truncate).lower()).start())
