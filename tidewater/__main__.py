"""Command line: the long-running jobs and the table checks.

    python -m tidewater ingest --bootstrap-servers host:9092 --topic users_created \\
        --table /data/users --dead-letters /data/users_dlq --checkpoint /chk/users
    python -m tidewater ingest --envelopes /landing/users ...     # envelope files instead of Kafka
    python -m tidewater wordcount --host localhost --port 9998 --console
    python -m tidewater wordcount --lines /landing/text --table /data/words --checkpoint /chk/words
    python -m tidewater setup --schema spark_streams --table created_users
    python -m tidewater count --table /data/users
    python -m tidewater sample --table /data/users --limit 10

The master and cluster settings come from `spark-submit`; the session is
taken with `getOrCreate()`.  Streaming commands wait until the query ends
(`--available-now` processes what is there and stops).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tidewater import catalog
from tidewater.config import KafkaSettings, TableSettings
from tidewater.operators.keyed import row_count, sample_rows
from tidewater.schemas import USER_V1, USER_V2
from tidewater.session import ensure_checkpoint_dir
from tidewater.sinks.console import to_console
from tidewater.sinks.keyed_table import KeyedTable
from tidewater.sources.kafka import read_kafka_stream
from tidewater.sources.lines import read_lines, read_socket
from tidewater.sources.replay import read_envelopes
from tidewater.streaming.ingest import start_ingest
from tidewater.streaming.wordcount import start_word_count, word_count_table

USER_ORDER = ["timestamp", "partition", "offset"]


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewater")
    sub = p.add_subparsers(dest="cmd", required=True)

    i = sub.add_parser("ingest", help="messages -> keyed table + dead letters")
    i.add_argument("--bootstrap-servers", default=KafkaSettings.bootstrap_servers)
    i.add_argument("--topic", default=KafkaSettings.topic)
    i.add_argument("--starting-offsets", default=KafkaSettings.starting_offsets)
    i.add_argument("--max-offsets-per-trigger", type=int)
    i.add_argument("--envelopes", help="read envelope parquet files instead of Kafka")
    i.add_argument("--table", required=True)
    i.add_argument("--dead-letters", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--compact-every", type=int)
    i.add_argument("--available-now", action="store_true")
    i.add_argument("--with-dob", action="store_true",
                   help="keep the message's dob field (12 columns instead of 11)")

    w = sub.add_parser("wordcount", help="running word count over text lines")
    w.add_argument("--host", default="localhost")
    w.add_argument("--port", type=int, default=9998)
    w.add_argument("--lines", help="read text files instead of a socket")
    w.add_argument("--console", action="store_true", help="complete mode to the console")
    w.add_argument("--table")
    w.add_argument("--checkpoint")
    w.add_argument("--available-now", action="store_true")
    w.add_argument("--compact-every", type=int)
    w.add_argument("--state-partitions", type=int,
                   help="state partitions, fixed when the query first starts")

    s = sub.add_parser("setup", help="CREATE SCHEMA / TABLE IF NOT EXISTS")
    s.add_argument("--schema", default=TableSettings.schema)
    s.add_argument("--table", default=TableSettings.table)
    s.add_argument("--location")

    c = sub.add_parser("count", help="row count of a keyed table")
    c.add_argument("--table", required=True)
    c.add_argument("--key", default="id")

    m = sub.add_parser("sample", help="first rows of a keyed table by key")
    m.add_argument("--table", required=True)
    m.add_argument("--key", default="id")
    m.add_argument("--columns", default="id,first_name,last_name,email")
    m.add_argument("--limit", type=int, default=10)
    return p


def main(argv=None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"tidewater-{a.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)

    if a.cmd == "ingest":
        if a.envelopes:
            source = read_envelopes(spark, a.envelopes, streaming=True)
        else:
            source = read_kafka_stream(spark, KafkaSettings(
                bootstrap_servers=a.bootstrap_servers, topic=a.topic,
                starting_offsets=a.starting_offsets,
                max_offsets_per_trigger=a.max_offsets_per_trigger))
        table = KeyedTable(spark, a.table, key="id", order=USER_ORDER)
        start_ingest(source, table, a.dead_letters, a.checkpoint,
                     schema=USER_V2 if a.with_dob else USER_V1,
                     available_now=a.available_now,
                     compact_every=a.compact_every).awaitTermination()
    elif a.cmd == "wordcount":
        lines = read_lines(spark, a.lines, streaming=True) if a.lines else read_socket(spark, a.host, a.port)
        if a.console:
            from tidewater.operators.wordcount import word_counts
            to_console(word_counts(lines)).awaitTermination()
        else:
            if not (a.table and a.checkpoint):
                raise SystemExit("wordcount needs --table and --checkpoint (or --console)")
            start_word_count(lines, word_count_table(spark, a.table), a.checkpoint,
                             available_now=a.available_now,
                             compact_every=a.compact_every,
                             partitions=a.state_partitions).awaitTermination()
    elif a.cmd == "setup":
        catalog.setup_schema(spark, TableSettings(schema=a.schema, table=a.table), a.location)
    elif a.cmd == "count":
        n = row_count(KeyedTable(spark, a.table, key=a.key, order=USER_ORDER).current()).first()[0]
        print(f"Current row count: {n}")
    elif a.cmd == "sample":
        view = KeyedTable(spark, a.table, key=a.key, order=USER_ORDER).current()
        sample_rows(view, a.columns.split(","), a.limit, order=[a.key]).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
