"""Connectors whose jars are absent here: options are built as intended."""

from tidewater.config import KafkaSettings
from tidewater.sinks.kafka import _options, to_messages
from tidewater.sources.kafka import kafka_options


def test_kafka_source_options():
    o = kafka_options(KafkaSettings(bootstrap_servers="b:9092", topic="t",
                                    starting_offsets="latest", max_offsets_per_trigger=500))
    assert o == {"kafka.bootstrap.servers": "b:9092", "subscribe": "t",
                 "startingOffsets": "latest", "maxOffsetsPerTrigger": "500"}


def test_kafka_sink_options_and_messages(spark):
    o = _options(KafkaSettings(bootstrap_servers="b:9092", topic="t"))
    assert o["topic"] == "t" and o["kafka.acks"] == "all" and o["kafka.retries"] == "3"
    df = spark.createDataFrame([("1", "A")], "id string, first_name string")
    row = to_messages(df, ["id", "first_name"]).first()
    assert row.key is None and bytes(row.value) == b'{"id":"1","first_name":"A"}'


def test_cassandra_options():
    from tidewater.config import TableSettings
    from tidewater.sinks.cassandra import FORMAT, cassandra_options

    assert FORMAT == "org.apache.spark.sql.cassandra"
    assert cassandra_options(TableSettings("k", "t"), "/chk") == {
        "keyspace": "k", "table": "t", "checkpointLocation": "/chk"}
