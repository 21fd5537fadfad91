"""Streams with late, repeated, silent and unmatched rows against batch results."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidewater.operators import runs
from tidewater.schemas import ATTEMPTS, ENVELOPE
from tidewater.streaming.late_runs import (attempt_balance, heartbeats, late_run_stats_view, rejected_attempts,
                                           start_late_run_stats)

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def land(spark, rows, path, schema=ATTEMPTS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda t: tuple((x is None, x) for x in t))


def test_late_runs_over_batches(spark, scratch):
    """Out of order inside the watermark, too late, missing fields, a heartbeat, a
    negative run number, equal times, a repeated attempt; counted + set aside = arrived."""
    def run(batch):
        land(spark, batch, f"{scratch}/in")
        q = start_late_run_stats(spark.readStream.schema(ATTEMPTS).parquet(f"{scratch}/in"), f"{scratch}/out", f"{scratch}/ck",
                                 2, slot_seconds=600, lateness="30 minutes", available_now=True, partitions=2, buckets=2)
        q.awaitTermination()
        return [p["observedMetrics"]["attempts"] for p in q.recentProgress]

    first = [(1, 5, at(50), True), (1, 1, at(3), False), (1, 2, at(3), False), (-2, 1, at(31), True), (1, 3, at(12), True)]
    # the watermark stands at minute 20: slots 0 and 1 are closed from now on
    second = [(1, 9, at(8), True), (-2, 2, at(25), False), (-2, 2, at(25), False), (1, 4, at(19), False), (3, 1, at(55), False),
              (None, 7, at(56), True), (4, None, at(56), True), (4, 8, None, False), (4, 9, at(57), None)]
    run(first)
    metrics = run(second)
    assert sum(m["arrived"] for m in metrics) == len(second)
    closing = heartbeats(spark, [at(600)]).collect()
    assert sum(m["heartbeats"] for m in run([tuple(r) for r in closing])) == 1
    late = [(1, 9, at(8), True), (1, 4, at(19), False)]
    bad = second[5:]
    good = spark.createDataFrame([r for r in first + second if r not in late + bad], ATTEMPTS)
    assert rows(late_run_stats_view(spark, f"{scratch}/out", 2)) == rows(runs.run_stats(good, 2))
    aside = [(*r[:2], r[2] and r[2].replace(tzinfo=None), *r[3:]) for r in rows(rejected_attempts(spark, f"{scratch}/out"))]
    want = [(*r, "late") for r in late] + [(*r, "missing_field") for r in bad]
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted(aside, key=key) == sorted([(*r[:2], r[2] and r[2].replace(tzinfo=None), *r[3:]) for r in want], key=key)
    arrived = spark.read.schema(ATTEMPTS).parquet(f"{scratch}/in")
    assert attempt_balance(arrived, f"{scratch}/out").first().asDict() == {
        "arrived": 14, "counted": 8, "late": 2, "missing_field": 4, "waiting": 0}


def test_slots_wait_without_a_heartbeat(spark, scratch):
    land(spark, [(1, 1, at(0), True), (1, 2, at(5), True)], f"{scratch}/in")
    start_late_run_stats(spark.readStream.schema(ATTEMPTS).parquet(f"{scratch}/in"), f"{scratch}/out", f"{scratch}/ck",
                         2, available_now=True, partitions=1, buckets=1).awaitTermination()
    balance = attempt_balance(spark.read.schema(ATTEMPTS).parquet(f"{scratch}/in"), f"{scratch}/out").first()
    assert (balance.arrived, balance.counted, balance.waiting) == (2, 0, 2)


@pytest.mark.parametrize("kind", ["runs", "baseline"])
def test_keyed_state_on_a_session_with_default_stores(spark, scratch, kind):
    """Spark's default state store cannot hold these queries' state."""
    from tidewater.streaming.baseline import start_daily_scores

    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(key, default)
    try:
        if kind == "runs":
            for batch in ([(1, 1, at(0), True), (1, 2, at(5), False)], [tuple(r) for r in heartbeats(spark, [at(9000)]).collect()]):
                land(spark, batch, f"{scratch}/in")
                start_late_run_stats(spark.readStream.schema(ATTEMPTS).parquet(f"{scratch}/in"), f"{scratch}/out", f"{scratch}/ck", 2,
                                     available_now=True, partitions=1, buckets=1).awaitTermination()
            got = late_run_stats_view(spark, f"{scratch}/out", 2).select("run_id", "messages_sent", "errors")
            assert rows(got) == [(1, 1, 1)]
        else:
            schema = "event_type string, ts timestamp"
            for batch in ([("a", at(0)), ("a", at(1440)), ("a", at(1441))], [("", at(90_000))]):
                land(spark, batch, f"{scratch}/in", schema)
                start_daily_scores(spark.readStream.schema(schema).parquet(f"{scratch}/in"), f"{scratch}/out", f"{scratch}/ck",
                                   available_now=True, partitions=1).awaitTermination()
            assert sorted(r.n for r in spark.read.parquet(f"{scratch}/out").collect()) == [1, 2]
        assert spark.conf.get(key) == default
    finally:
        spark.conf.set(key, old)


def test_queries_hold_late_rows(spark):
    """The registered query on late data has late attempts, so it shows something."""
    from conftest import SF_SMALL
    from tidewater.plans.queries import late_attempts
    got = late_attempts(spark, SF_SMALL).agg(F.sum("late").alias("late"), F.sum("arrived").alias("arrived"),
                                             F.count("messages_sent").alias("runs")).first()
    assert 0 < got.late < got.arrived and got.runs > 0


def test_dedup_keeps_one_of_each_message(spark, scratch):
    from tidewater.streaming.dedup import deduplicated, dropped_as_late, start_dedup

    def message(offset, minute, value=b"x", topic="t"):
        return (None, value, topic, 0, offset, at(minute), 0)

    def run(batch):
        land(spark, batch, f"{scratch}/in", ENVELOPE)
        q = start_dedup(spark.readStream.schema(ENVELOPE).parquet(f"{scratch}/in"), f"{scratch}/out", f"{scratch}/ck",
                        "10 minutes", available_now=True, partitions=2)
        q.awaitTermination()
        return dropped_as_late(q)

    assert run([message(1, 0), message(1, 0), message(2, 1), message(2, 1, topic="u")]) == 0
    assert run([message(1, 0), message(3, 8), message(3, 8), message(4, 30)]) == 0  # a late copy, within the watermark
    assert run([message(2, 1), message(4, 30), message(5, 31)]) == 1                # a copy behind the watermark
    out = spark.read.parquet(f"{scratch}/out")
    assert sorted((r.topic, r.offset) for r in out.collect()) == [("t", k) for k in range(1, 6)] + [("u", 2)]
    batch = deduplicated(spark.read.schema(ENVELOPE).parquet(f"{scratch}/in"))
    assert sorted(r.message_id for r in out.collect()) == sorted(r.message_id for r in batch.collect())


def test_sessions_merge_in_any_order(spark, scratch):
    from tidewater.streaming.sessions import attempt_sessions, start_sessions

    first = [(1, 1, at(0), True), (1, 2, at(18), False), (2, 3, at(0), True), (None, 4, at(1), True), (3, 5, None, True)]
    second = [(1, 6, at(9), True), (1, 7, at(40), None), (2, 8, at(10), False)]  # joins two sessions of run 1
    for batch in (first, second, [tuple(r) for r in heartbeats(spark, [at(900)]).collect()]):
        land(spark, batch, f"{scratch}/in")
        start_sessions(spark.readStream.schema(ATTEMPTS).parquet(f"{scratch}/in"), f"{scratch}/out", f"{scratch}/ck", "10 minutes",
                       "1 hour", available_now=True, partitions=2).awaitTermination()
    got = rows(spark.read.parquet(f"{scratch}/out").where("run_id is not null"))
    assert [(r[0], *r[3:]) for r in got] == [(1, 1, 0, 0), (1, 3, 2, 1), (2, 2, 1, 1)] or \
        sorted((r[0], *r[3:]) for r in got) == [(1, 1, 0, 0), (1, 3, 2, 1), (2, 2, 1, 1)]
    batch = attempt_sessions(spark.createDataFrame(first + second, ATTEMPTS).where("run_id is not null"), "10 minutes")
    assert got == rows(batch)


@pytest.mark.parametrize("stream", [False, True])
def test_confirmations(spark, scratch, stream):
    from tidewater.streaming.confirm import confirmed_attempts, start_confirmed

    second = lambda s: T0 + timedelta(seconds=s)
    a = [(1, 1, second(0)), (1, 2, second(1)), (1, 3, second(2)), (2, 4, second(3)), (2, 5, None), (2, None, second(4))]
    c = [(1, second(10)), (2, second(12)), (4, second(2)), (9, second(3)), (None, second(4))]
    a_schema, c_schema = "run_id long, seq long, ts timestamp", "seq long, confirmed_at timestamp"
    want = [(1, 1, True), (1, 2, False), (1, 3, False), (2, 4, False), (2, None, False)]
    if not stream:
        got = confirmed_attempts(spark.createDataFrame(a, a_schema), spark.createDataFrame(c, c_schema))
        assert sorted(((r.run_id, r.seq, r.ok) for r in got.collect() if r.ts), key=str) == sorted(want, key=str)
        return
    end = second(90_000)
    for k, (x, y) in enumerate([(a[:2], c[2:]), (a[2:], c[:2]), ([(None, None, end)], [(-1, end)])]):
        land(spark, x, f"{scratch}/a", a_schema)
        land(spark, y, f"{scratch}/c", c_schema)
        start_confirmed(spark.readStream.schema(a_schema).parquet(f"{scratch}/a"), spark.readStream.schema(c_schema).parquet(f"{scratch}/c"),
                        f"{scratch}/out", f"{scratch}/ck", available_now=True, partitions=2).awaitTermination()
    got = spark.read.parquet(f"{scratch}/out").where("ts is not null and run_id is not null")
    assert sorted(((r.run_id, r.seq, r.ok) for r in got.collect()), key=str) == sorted(want, key=str)


def test_state_is_read_as_of_a_batch(spark, scratch):
    from tidewater.streaming.audit import state_rows, stateful_operators
    from tidewater.streaming.wordcount import start_word_count_complete

    for words in ("a b a", "b c"):
        spark.createDataFrame([(words,)], "text string").coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        start_word_count_complete(spark.readStream.schema("text string").parquet(f"{scratch}/in"), f"{scratch}/out",
                                  f"{scratch}/ck", "text", available_now=True, partitions=2).awaitTermination()
    state = lambda **k: dict((r.word, r["count"]) for r in state_rows(spark, f"{scratch}/ck", **k).collect())
    assert state() == {"a": 2, "b": 2, "c": 1} and state(batch=0) == {"a": 2, "b": 1}
    assert stateful_operators(spark, f"{scratch}/ck").first()["numPartitions"] == 2
