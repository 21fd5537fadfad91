"""Streaming equals batch; a batch that fails after writing is replayed
on restart without changing the result."""

from pyspark.sql import functions as F

from tidewater.operators import decode, keyed, wordcount
from tidewater.plans import derive
from tidewater.plans.tables import table
from tidewater.schemas import USER_V1, USER_V1_COLUMNS
from tidewater.sinks.keyed_table import KeyedTable, write_split
from tidewater.sources.replay import read_envelopes, write_envelopes
from tidewater.streaming.ingest import start_ingest
from tidewater.streaming.wordcount import start_word_count, word_count_table

from conftest import SF_SMALL

ORDER = ["timestamp", "partition", "offset"]


def envelopes(spark, path):
    env = derive.events_envelope(table(spark, SF_SMALL, "events"), derive.mixed_user_message())
    write_envelopes(env, path, files=3)
    return env


def batch_view(env):
    good = decode.accepted(decode.decode_envelope(env, USER_V1))
    return keyed.latest_per_key(good, "id", ORDER).select(*USER_V1_COLUMNS)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ingest_stream_equals_batch_and_conserves(spark, scratch):
    env = envelopes(spark, f"{scratch}/landing")
    stream = read_envelopes(spark, f"{scratch}/landing", streaming=True, max_files_per_trigger=1)
    t = KeyedTable(spark, f"{scratch}/table", "id", ORDER)
    q = start_ingest(stream, t, f"{scratch}/dlq", f"{scratch}/ckpt", available_now=True)
    q.awaitTermination()
    assert rows(t.current().select(*USER_V1_COLUMNS)) == rows(batch_view(env))
    # accepted + rejected = input
    n_in = env.count()
    n_bad = spark.read.parquet(f"{scratch}/dlq").count()
    n_good = decode.accepted(decode.decode_envelope(env, USER_V1)).count()
    assert n_good + n_bad == n_in and n_bad > 0


def test_failed_batch_is_replayed_on_restart(spark, scratch):
    env = envelopes(spark, f"{scratch}/landing")
    t = KeyedTable(spark, f"{scratch}/table", "id", ORDER)
    cols = [*ORDER, *USER_V1_COLUMNS]
    state = {"failed": False}

    def flaky(df, batch_id):
        write_split(df, t, f"{scratch}/dlq", batch_id, ["topic", *cols])
        if batch_id == 1 and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("crash after the write")

    def start():
        stream = read_envelopes(spark, f"{scratch}/landing", streaming=True,
                                max_files_per_trigger=1)
        return (decode.decode_envelope(stream, USER_V1).writeStream.foreachBatch(flaky)
                .option("checkpointLocation", f"{scratch}/ckpt")
                .trigger(availableNow=True).start())

    q = start()
    try:
        q.awaitTermination()
    except Exception:
        pass
    assert state["failed"]
    start().awaitTermination()
    assert rows(t.current().select(*USER_V1_COLUMNS)) == rows(batch_view(env))


def test_word_count_stream_equals_batch(spark, scratch):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    docs.repartitionByRange(3, "doc_id").write.parquet(f"{scratch}/landing")
    lines = (spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", "1")
             .parquet(f"{scratch}/landing"))
    t = word_count_table(spark, f"{scratch}/table")
    start_word_count(lines, t, f"{scratch}/ckpt", text_col="text",
                     available_now=True).awaitTermination()
    assert rows(t.current()) == rows(wordcount.word_counts(docs, "text"))


def test_text_line_stream_word_count(spark, scratch):
    # Stand-in for the socket source: the same `value string` lines from files.
    from tidewater.sources.lines import read_lines

    lines = ["a  b ", "", "b a", "the the the"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.text(f"{scratch}/lines")
    t = word_count_table(spark, f"{scratch}/table")
    start_word_count(read_lines(spark, f"{scratch}/lines", streaming=True), t,
                     f"{scratch}/ckpt", available_now=True).awaitTermination()
    got = dict((r.word, r["count"]) for r in t.current().collect())
    assert got == {"a": 2, "b": 2, "": 3, "the": 3}


def test_stream_static_enrichment_equals_batch(spark, scratch):
    from tidewater.operators.enrich import enrich_events

    t = lambda n: table(spark, SF_SMALL, n)
    events = t("events")
    events.repartition(3).write.parquet(f"{scratch}/ev")
    stream = spark.readStream.schema(events.schema).parquet(f"{scratch}/ev")
    out = enrich_events(stream, t("customer"), t("nation"), t("region"))
    (out.writeStream.format("parquet").option("path", f"{scratch}/out")
        .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True)
        .start().awaitTermination())
    want = enrich_events(events, t("customer"), t("nation"), t("region"))
    assert rows(spark.read.parquet(f"{scratch}/out")) == rows(want)


def test_daily_counts_stream_has_watermark_and_window(spark, scratch):
    from tidewater.operators.anomaly import streaming_daily_counts

    ev = table(spark, SF_SMALL, "events").select("event_type", "ts")
    ev.write.parquet(f"{scratch}/ev")
    stream = spark.readStream.schema(ev.schema).parquet(f"{scratch}/ev")
    plan = streaming_daily_counts(stream)._jdf.queryExecution().analyzed().toString()
    assert "EventTimeWatermark" in plan


def test_state_partitions_leave_session_setting(spark, scratch):
    from tidewater.streaming.ingest import state_partitions

    before = spark.conf.get("spark.sql.shuffle.partitions")
    with state_partitions(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
