"""Text line sources: a socket (not replayable; demos only) or text files
(replayable).  Both give one `value string` column per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_socket(spark: SparkSession, host: str = "localhost", port: int = 9998) -> DataFrame:
    return (spark.readStream.format("socket").option("host", host)
            .option("port", str(port)).load())


def read_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(path)
