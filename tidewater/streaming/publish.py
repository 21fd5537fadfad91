"""The publish job: landed responses -> flat users -> accepted ones -> messages.

`reshaped` is written once and read back before it is filtered, since a filter
on a parse output would parse every response a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.config import KafkaSettings
from tidewater.operators.profile import reshape_profiles
from tidewater.sinks.kafka import publish_batch, to_messages


def accepted_users(raw: DataFrame, raw_col: str, id_parts: Sequence, folder: str) -> DataFrame:
    """Reshape `raw`, keep all results with their reasons in `folder`, and
    return the accepted users."""
    users = reshape_profiles(raw, raw_col, id_parts)
    users.write.mode("overwrite").parquet(folder)
    kept = raw.sparkSession.read.schema(users.schema).parquet(folder)
    return kept.where(F.col("reject_reason").isNull()).drop("reject_reason")


def publish_responses(raw: DataFrame, raw_col: str, id_parts: Sequence, folder: str,
                      settings: KafkaSettings | None = None) -> str:
    """Publish to Kafka, or without `settings` to message files (key, value)
    under `folder`; returns the folder of the messages."""
    users = accepted_users(raw, raw_col, id_parts, f"{folder}/reshaped")
    if settings:
        publish_batch(users, settings)
    else:
        to_messages(users).write.mode("overwrite").parquet(f"{folder}/messages")
    return f"{folder}/messages"
