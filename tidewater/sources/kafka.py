"""Kafka source: one topic, envelope columns as Spark's Kafka source gives
them (`key, value, topic, partition, offset, timestamp, timestampType`).
The connector jar must be on the class path.  `starting_offsets` only
applies when the query has no checkpoint yet; afterwards the checkpoint's
offsets win."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.config import KafkaSettings


def kafka_options(settings: KafkaSettings) -> dict:
    opts = {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": settings.topic,
        "startingOffsets": settings.starting_offsets,
    }
    if settings.max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(settings.max_offsets_per_trigger)
    return opts


def read_kafka_stream(spark: SparkSession, settings: KafkaSettings = KafkaSettings()) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(settings)).load()


def read_kafka_batch(spark: SparkSession, settings: KafkaSettings = KafkaSettings()) -> DataFrame:
    opts = kafka_options(settings)
    opts.pop("maxOffsetsPerTrigger", None)
    return spark.read.format("kafka").options(**opts).load()
