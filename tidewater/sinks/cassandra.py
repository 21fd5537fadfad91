"""Pass-through to the Cassandra connector, whose jar must be on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidewater.config import TableSettings

FORMAT = "org.apache.spark.sql.cassandra"


def cassandra_options(settings: TableSettings, checkpoint: str) -> dict:
    """The host is a session setting: spark.cassandra.connection.host."""
    return {"keyspace": settings.schema, "table": settings.table, "checkpointLocation": checkpoint}


def to_cassandra(users: DataFrame, settings: TableSettings, checkpoint: str) -> StreamingQuery:
    """Append stream with the default trigger (a batch as soon as the last is done)."""
    return users.writeStream.format(FORMAT).options(**cassandra_options(settings, checkpoint)).start()
