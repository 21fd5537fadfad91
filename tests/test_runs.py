"""Run statistics: fixture sequences, duration edge, and a property test
against a direct simulation of the producer loop."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.operators import runs

T0 = dt.datetime(2024, 1, 1)


def attempts(spark, seqs):
    rows = []
    for run_id, s in enumerate(seqs):
        for i, c in enumerate(s):
            rows.append((run_id, i, T0 + dt.timedelta(seconds=i), c == "S"))
    return spark.createDataFrame(rows, "run_id long, seq long, ts timestamp, ok boolean")


def simulate(oks, limit):
    sent = err = streak = longest = 0
    for ok in oks:
        if streak >= limit:
            break
        if ok:
            sent, streak = sent + 1, 0
        else:
            err, streak = err + 1, streak + 1
            longest = max(longest, streak)
    return sent, err, longest, streak >= limit


def test_fixture_sequences(spark):
    seqs = ["SSES", "EESEE", "SEEESS"]
    got = {r.run_id: (r.messages_sent, r.errors, r.longest_streak, r.stopped)
           for r in runs.run_stats(attempts(spark, seqs), 3).collect()}
    assert got == {0: (3, 1, 1, False), 1: (1, 4, 2, False), 2: (1, 3, 3, True)}


def test_no_attempts_no_row(spark):
    empty = spark.createDataFrame([], "run_id long, seq long, ts timestamp, ok boolean")
    assert runs.run_stats(empty, 3).count() == 0


def test_duration_is_half_open(spark):
    df = attempts(spark, ["S" * 10])  # one attempt per second
    kept = runs.within_duration(df, 5).select("seq").collect()
    assert sorted(r.seq for r in kept) == [0, 1, 2, 3, 4]


@settings(max_examples=15, deadline=None)
@given(
    seqs=st.lists(st.text(alphabet="SE", min_size=1, max_size=60), min_size=1, max_size=5),
    limit=st.integers(1, 4),
    parts=st.integers(1, 6),
)
def test_matches_simulation(spark, seqs, limit, parts):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r.run_id: (r.messages_sent, r.errors, r.longest_streak, r.stopped)
               for r in runs.run_stats(attempts(spark, seqs), limit, partitions=parts).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {i: simulate([c == "S" for c in s], limit) for i, s in enumerate(seqs)}
    assert got == want


def test_hot_run_is_split_across_partitions(spark):
    # One run with most of the rows: the scan must still give one summary
    # per partition it spans, and the same answer as the simulation.
    pattern = ("SE" * 50 + "EE" + "S") * 20 + "EEE" + "S" * 100
    df = attempts(spark, [pattern, "SES"])
    summ = runs.streak_summaries(df, 3, partitions=8).collect()
    assert len({r.pid for r in summ if r.run_id == 0}) > 1
    got = {r.run_id: (r.messages_sent, r.errors, r.longest_streak, r.stopped)
           for r in runs.run_stats(df, 3, partitions=8).collect()}
    assert got[0] == simulate([c == "S" for c in pattern], 3)


def test_fold_is_associative(spark):
    # Folding a prefix first and then the rest equals folding everything:
    # the streaming form relies on it.
    from pyspark.sql import functions as F
    seqs = ["SEEESEEEES", "EEEEE", "SESESE", "EESEEEESS"]
    df = attempts(spark, seqs)
    whole = runs.finish(runs.fold(runs.streak_summaries(df, 3, partitions=4), 3), 3)
    first = df.where(F.col("seq") < 4)
    rest = df.where(F.col("seq") >= 4)
    prefix = runs.fold(runs.streak_summaries(first, 3, partitions=2), 3)
    pieces = runs.streak_summaries(rest, 3, partitions=3).unionByName(
        prefix.select(F.lit(-1).alias("pid"), "run_id", *runs.PIECE))
    step = runs.finish(runs.fold(pieces, 3), 3)
    assert sorted(map(tuple, step.collect())) == sorted(map(tuple, whole.collect()))


def test_streaming_equals_batch(spark, scratch):
    from tidewater.schemas import ATTEMPTS
    from tidewater.streaming.runs import run_state_table, run_stats_view, start_run_stats

    seqs = ["SEEESEEEES" * 3, "EEEEE", "SESESE" * 4, "EESEEEESS" * 2]
    df = attempts(spark, seqs)
    state = run_state_table(spark, f"{scratch}/state")
    for lo, hi in [(0, 7), (7, 15), (15, 40)]:
        df.where((df.seq >= lo) & (df.seq < hi)).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(ATTEMPTS).parquet(f"{scratch}/in")
        start_run_stats(stream, state, f"{scratch}/ckpt", 3, available_now=True).awaitTermination()
    got = sorted(map(tuple, run_stats_view(state, 3).collect()))
    assert got == sorted(map(tuple, runs.run_stats(df, 3).collect()))


def test_streaming_replay_after_state_write_counts_once(spark, scratch):
    from tidewater.schemas import ATTEMPTS
    from tidewater.streaming.runs import fold_batch, run_state_table, run_stats_view

    seqs = ["SEEESEEEES" * 3, "EEEEE", "SESESE" * 4, "EESEEEESS" * 2]
    df = attempts(spark, seqs)
    state = run_state_table(spark, f"{scratch}/state")
    crashed = {"done": False}

    def flaky(batch, batch_id):
        fold_batch(batch, batch_id, state, 3)
        if batch_id == 1 and not crashed["done"]:
            crashed["done"] = True
            raise RuntimeError("crash after the state write")

    def run_once():
        stream = spark.readStream.schema(ATTEMPTS).parquet(f"{scratch}/in")
        q = (stream.writeStream.foreachBatch(flaky)
             .option("checkpointLocation", f"{scratch}/ckpt")
             .trigger(availableNow=True).start())
        try:
            q.awaitTermination()
        except Exception:
            pass

    for lo, hi in [(0, 7), (7, 15), (15, 40)]:
        df.where((df.seq >= lo) & (df.seq < hi)).write.mode("append").parquet(f"{scratch}/in")
        run_once()
    run_once()  # restart: batch 1 is replayed
    assert crashed["done"]
    got = sorted(map(tuple, run_stats_view(state, 3).collect()))
    assert got == sorted(map(tuple, runs.run_stats(df, 3).collect()))


def test_streaming_rejects_out_of_order_attempts(spark, scratch):
    import pytest

    from tidewater.streaming.runs import OutOfOrderAttempts, fold_batch, run_state_table

    df = attempts(spark, ["SEESSE"])
    state = run_state_table(spark, f"{scratch}/state")
    fold_batch(df.where(df.seq >= 3), 0, state, 3)
    with pytest.raises(OutOfOrderAttempts):
        fold_batch(df.where(df.seq < 3), 1, state, 3)


def test_hot_run_is_dealt_by_salt(spark):
    from pyspark.sql import functions as F

    from tidewater.operators.runs import within_duration

    a = spark.range(20_000).select(F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id")).alias("run_id"),
                                   F.col("id").alias("seq"), F.timestamp_seconds("id").alias("ts"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = within_duration(a, 100)
        p = out._jdf.queryExecution().toString()
        assert "_salt" in p and "hashpartitioning(run_id" in p
        join = [x for x in p.splitlines() if "Join" in x and "run_id" in x][-1]
        assert "_salt" in join
        assert out.where("run_id = 0").count() == a.where("run_id = 0 and seq < 100").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_new_checkpoint_goes_on_from_the_state(spark, scratch):
    from tidewater.schemas import ATTEMPTS
    from tidewater.streaming.runs import fold_batch, run_state_table, run_stats_view, start_run_stats

    df = attempts(spark, ["SEESSEES" * 3, "EEEEE", "SESESE" * 4])
    state = run_state_table(spark, f"{scratch}/state")
    cut = [(0, 7), (7, 11), (11, 16), (16, 40)]
    for k, (lo, hi) in enumerate(cut):  # two batches under each of two checkpoints
        where = f"{scratch}/in{k // 2}"
        df.where((df.seq >= lo) & (df.seq < hi)).write.mode("append").parquet(where)
        stream = spark.readStream.schema(ATTEMPTS).parquet(where)
        start_run_stats(stream, state, f"{scratch}/ckpt{k // 2}", 3, available_now=True).awaitTermination()
        if k == 2:
            state.compact()
    want = sorted(map(tuple, runs.run_stats(df, 3).collect()))
    assert sorted(map(tuple, run_stats_view(state, 3).collect())) == want
    # a replay of any batch, also one that others have folded upon, changes nothing
    from tidewater.sinks.keyed_table import writer_of
    for k, (lo, hi) in [(3, cut[3]), (1, cut[1])]:
        fold_batch(df.where((df.seq >= lo) & (df.seq < hi)), k % 2, state, 3, writer_of(f"{scratch}/ckpt{k // 2}"))
        assert sorted(map(tuple, run_stats_view(state, 3).collect())) == want


def test_folds_at_the_same_time_are_reported(spark, scratch):
    import pytest

    from tidewater.streaming.runs import ConcurrentFolds, fold_batch, run_state_table, run_stats_view

    df = attempts(spark, ["SEESSE"])
    state = run_state_table(spark, f"{scratch}/state")
    fold_batch(df.where(df.seq < 3), 0, state, 3, "one")
    state.upsert(state.current(), 0, "two/0")
    with pytest.raises(ConcurrentFolds):
        fold_batch(df.where(df.seq >= 3), 1, state, 3, "one")
    with pytest.raises(ConcurrentFolds):
        run_stats_view(state, 3)
