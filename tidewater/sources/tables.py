"""Reading a target table back, with the columns chosen (point in time)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.table(name)
    return df.select(*columns) if columns else df
