"""Publishing records as messages: Kafka, or envelope files offline.

A message is the record as a JSON object (nulls kept) encoded as UTF-8 in
`value`; the producer sets no key.  Producer settings map to `kafka.*`
options.  The Kafka connector jar must be on the class path to run it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.config import KafkaSettings
from tidewater.functions.codec import encode_utf8, message_json
from tidewater.schemas import MESSAGE_KEYS


def to_messages(records: DataFrame, keys: Sequence[str] = MESSAGE_KEYS) -> DataFrame:
    return records.select(
        F.lit(None).cast("binary").alias("key"),
        encode_utf8(message_json(keys)).alias("value"),
    )


def _options(settings: KafkaSettings) -> dict:
    opts = {"kafka.bootstrap.servers": settings.bootstrap_servers, "topic": settings.topic}
    opts.update({f"kafka.{k}": str(v) for k, v in settings.producer_options.items()})
    return opts


def publish_stream(records: DataFrame, settings: KafkaSettings, checkpoint: str):
    return (to_messages(records).writeStream.format("kafka").options(**_options(settings))
            .option("checkpointLocation", checkpoint).start())


def publish_batch(records: DataFrame, settings: KafkaSettings) -> None:
    to_messages(records).write.format("kafka").options(**_options(settings)).save()
