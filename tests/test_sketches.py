"""Mergeable summaries and the incremental baseline against exact results."""

import math
import statistics

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater.operators import anomaly, logs, sketches, wordcount
from tidewater.plans import derive
from tidewater.plans.tables import table
from tidewater.streaming import baseline


def calls(spark, rows):
    return spark.createDataFrame(rows, "function_name string, timestamp string, latency_s double")


def test_sketches_merge_over_hours_and_batches(spark):
    rows = [("f", f"2024-01-01T{h:02d}:10:00Z", float(h * 100 + i)) for h in range(24) for i in range(100)]
    rows += [("g", "2024-01-01T00:00:00Z", 7.0), ("g", None, 9.0), ("g", "2024-01-01T00:30:00Z", None), (None, "no time", 1.0)]
    df = calls(spark, rows)
    one = sketches.latency_sketches(df)
    assert sorted((r.function_name or "", r.calls) for r in one.collect()) == [("", 1)] + [("f", 100)] * 24 + [("g", 1)] * 2
    halves = [sketches.latency_sketches(df.where(F.col("latency_s") % 2 == k)) for k in (0, 1)]
    for parts in (one, halves[0].unionByName(halves[1])):
        got = {r.function_name: r for r in sketches.quantiles(
            sketches.merged_sketches(parts, "function_name"), p50=0.5, p99=0.99).collect()}
        assert got["f"].calls == 2400 and abs(got["f"].p50 - 1200) <= 2400 * 2 * sketches.RANK_ERROR
        assert abs(got["f"].p99 - 2376) <= 2400 * 2 * sketches.RANK_ERROR
        assert got["g"].calls == 2 and got[None].p50 == 1.0


def test_heavy_words_are_the_exact_ones(spark):
    docs = table(spark, SF_SMALL, "documents")
    want = [tuple(r) for r in wordcount.word_counts(docs, "text").orderBy(F.desc("count"), "word").limit(20).collect()]
    assert [tuple(r) for r in sketches.heavy_words(docs, "text", 20).collect()] == want
    # more words than counters: what is heavy is still found and counted exactly
    lines = spark.range(30_000).select(F.concat(F.lit("hot warm "), F.when(F.col("id") % 3 == 0, "mild ").otherwise(""),
                                                F.col("id").cast("string")).alias("value"))
    got = [tuple(r) for r in sketches.heavy_words(lines, top=3, tracked=512).collect()]
    assert got == [("hot", 30_000), ("warm", 30_000), ("mild", 10_000)]
    assert sketches.heavy_words(lines.limit(0)).count() == 0


def test_scores_look_back_only():
    days = [5, 5, 7, 10 ** 12, 3, 3]
    count = total = squares = 0
    for k, n in enumerate(days):
        z, seen = baseline._z(n, count, total, squares), days[:k]
        if k < 2 or statistics.stdev(seen) == 0:
            assert math.isnan(z)
        else:
            assert math.isclose(z, (n - statistics.mean(seen)) / statistics.stdev(seen), rel_tol=1e-9)
        count, total, squares = count + 1, total + n, squares + n * n


def test_baseline_stream_goes_on_from_its_state(spark, scratch):
    ev = table(spark, SF_SMALL, "events").select("event_type", "ts")
    want = {(r.event_type, r.day): r.z for r in baseline.scored_days(anomaly.daily_counts(ev, "ts", "event_type")).collect()}
    day = F.dayofmonth("ts")
    far = spark.createDataFrame([("", "2025-01-01 00:00:00")], "event_type string, ts string").select(
        "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))
    for part in (ev.where(day < 12), ev.where(day >= 12), far):
        part.coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        baseline.start_daily_scores(spark.readStream.schema(ev.schema).parquet(f"{scratch}/in"), f"{scratch}/out",
                                    f"{scratch}/ck", available_now=True, partitions=2).awaitTermination()
    got = {(r.event_type, r.day): r.z for r in baseline.scores_view(spark.read.parquet(f"{scratch}/out")).collect()}
    assert got == want


def test_the_filter_reaches_the_scan(spark):
    from tidewater.plans.queries import enrich_filtered
    plan = enrich_filtered(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(value,50.0)" in plan and "In(event_type" in plan


def test_log_lines_and_console_as_streams(spark, scratch, capfd):
    """Default trigger, started, fed, processed and stopped."""
    from tidewater.sinks.console import to_console
    from tidewater.sinks.log_lines import stream_log_lines

    derive.event_log_lines(table(spark, SF_SMALL, "events")).coalesce(1).write.mode("append").text(f"{scratch}/in")
    lines = spark.readStream.text(f"{scratch}/in")
    q = stream_log_lines(lines, f"{scratch}/out", f"{scratch}/ck")
    q.processAllAvailable()
    assert q.isActive
    derive.event_log_lines(table(spark, SF_SMALL, "events").limit(5)).coalesce(1).write.mode("append").text(f"{scratch}/in")
    q.processAllAvailable()
    q.stop()
    back = logs.parse_logs(spark.read.text(f"{scratch}/out"))
    assert back.count() == 1005 and back.where("latency_s is null").count() == 0
    console = to_console(wordcount.word_counts(spark.readStream.text(f"{scratch}/in")).where("count > 900").limit(3))
    console.processAllAvailable()
    assert console.lastProgress["numInputRows"] == 1005 and console.lastProgress["sink"]["description"].startswith("org.apache.spark.sql.execution.streaming")
    console.stop()


def test_ingest_with_the_default_trigger(spark, scratch):
    """T4, T5: no trigger given; rows that land while it runs are taken."""
    from tidewater.schemas import USER_V1_COLUMNS
    from tidewater.sinks.keyed_table import KeyedTable
    from tidewater.sources.replay import read_envelopes, write_envelopes
    from tidewater.streaming.ingest import start_ingest

    env = derive.events_envelope(table(spark, SF_SMALL, "events"), derive.user_message())
    write_envelopes(env.where("offset < 500"), f"{scratch}/in/a")
    users = KeyedTable(spark, f"{scratch}/t", "id", ["timestamp", "partition", "offset"])
    q = start_ingest(read_envelopes(spark, f"{scratch}/in/*", streaming=True), users, f"{scratch}/dlq", f"{scratch}/ck")
    q.processAllAvailable()
    first = users.current().count()
    write_envelopes(env.where("offset >= 500"), f"{scratch}/in/b")
    q.processAllAvailable()
    assert q.isActive
    q.stop()
    from tidewater.plans.queries import keyed_latest
    assert first > 0
    assert sorted(map(str, users.current().select(*USER_V1_COLUMNS).collect())) == sorted(map(str, keyed_latest(spark, SF_SMALL).collect()))
