"""Settings as plain frozen dataclasses, resolved on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field

from tidewater.schemas import DEFAULT_SCHEMA, DEFAULT_TABLE, DEFAULT_TOPIC


@dataclass(frozen=True)
class KafkaSettings:
    bootstrap_servers: str = "localhost:9092"
    topic: str = DEFAULT_TOPIC
    starting_offsets: str = "earliest"  # only used when no checkpoint exists
    # Upper bound of records per micro-batch; keeps one batch's state work
    # bounded however far behind the query is.
    max_offsets_per_trigger: int | None = None
    # Producer-side options for publishing (acks, retries, max block).
    producer_options: dict = field(
        default_factory=lambda: {"acks": "all", "retries": "3", "max.block.ms": "5000"}
    )


@dataclass(frozen=True)
class TableSettings:
    schema: str = DEFAULT_SCHEMA
    table: str = DEFAULT_TABLE
    key: str = "id"
    # Envelope coordinates that decide which write to a key is the last one.
    order: tuple = ("timestamp", "partition", "offset")


@dataclass(frozen=True)
class RunLimits:
    """Cut-offs of a producer run: stop after `max_errors` consecutive
    failures, or when `duration_seconds` have passed since the first try."""

    max_errors: int = 10
    duration_seconds: int = 60
