"""Landed API responses: one raw JSON response per line in text files.

The HTTP fetch itself is outside Spark; whatever lands the responses writes
them as text.  Each line is identified by its file path and its text, from
which the record id is derived (identical lines in one file share an id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_responses(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    df = reader.text(path)
    return df.select(F.col("_metadata.file_path").alias("source_path"),
                     F.col("value").alias("raw"))
