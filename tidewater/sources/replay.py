"""Envelope files: the Kafka envelope kept as parquet, read as a batch or
replayed as a stream.  Everything downstream of the source is the same as
for Kafka, which makes the whole flow testable without a broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.schemas import ENVELOPE


def read_envelopes(spark: SparkSession, path: str, streaming: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    if not streaming:
        return spark.read.schema(ENVELOPE).parquet(path)
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def write_envelopes(envelopes: DataFrame, path: str, files: int | None = None) -> None:
    """Store envelopes as parquet; `files` spreads them evenly over that many
    files.  Consumers order writes by the envelope coordinates, not by file,
    so no range sampling pass is spent on ordering the files."""
    out = envelopes
    if files:
        out = out.repartition(files)
    out.write.mode("errorifexists").parquet(path)
