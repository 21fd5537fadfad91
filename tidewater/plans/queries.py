"""Named queries: one per operator of the inventory, each over whole tables.

Every callable takes `(spark, sf_dir)` and returns a DataFrame whose column
names equal those of the matching SQL in `plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.config import RunLimits, TableSettings
from tidewater.functions.ids import derived_id
from tidewater.operators import anomaly, decode, enrich, keyed, logs, profile, runs, wordcount
from tidewater.plans import derive
from tidewater.plans.tables import table
from tidewater.schemas import USER_V1, USER_V1_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]

PROPS = StructType([StructField("k", StringType())])
EVENT_MESSAGE = StructType([StructField(k, StringType()) for k in derive.EVENT_MESSAGE_KEYS])


def json_decode_flatten(spark, sf_dir):
    """Bytes -> text -> from_json -> data.*"""
    env = derive.events_envelope(table(spark, sf_dir, "events"), F.col("props"), topic="events")
    out = decode.decode_envelope(env, PROPS, required=("k",), keep=("partition", "offset"))
    return out.select("partition", "offset", "k")


def envelope_roundtrip(spark, sf_dir):
    """Columns -> JSON text -> bytes -> envelope -> columns."""
    env = derive.events_envelope(table(spark, sf_dir, "events"), derive.event_message())
    out = decode.decode_envelope(env, EVENT_MESSAGE, required=("event_id",), keep=("offset",))
    return out.select("offset", *derive.EVENT_MESSAGE_KEYS)


def decode_reject(spark, sf_dir):
    """One parse, every record either accepted or given a reason."""
    env = derive.events_envelope(table(spark, sf_dir, "events"), derive.mixed_user_message())
    out = decode.decode_envelope(env, USER_V1)
    return out.select("partition", "offset", "id", "email", "reject_reason")


def decode_permissive(spark, sf_dir):
    """P1-P3 exactly as the consumer job does it: PERMISSIVE parse into the
    11 columns, no validation; malformed or empty messages come out as
    all-null rows."""
    env = derive.events_envelope(table(spark, sf_dir, "events"), derive.mixed_user_message())
    return decode.decode_values(env, USER_V1)


def derived_ids(spark, sf_dir):
    """F8: stable id from topic/partition/offset."""
    env = derive.events_envelope(table(spark, sf_dir, "events"), derive.user_message())
    return env.select("offset", derived_id("topic", "partition", "offset").alias("id"))


def keyed_latest(spark, sf_dir):
    """U1/U2 semantics end to end: user messages -> decode -> accepted ->
    last write per id by (timestamp, partition, offset)."""
    env = derive.events_envelope(table(spark, sf_dir, "events"), derive.user_message())
    decoded = decode.decode_envelope(env, USER_V1)
    latest = keyed.latest_per_key(
        decoded, "id", ["timestamp", "partition", "offset"],
        keep=F.col("reject_reason").isNull(),
        columns=["timestamp", "partition", "offset", *USER_V1_COLUMNS],
    )
    return latest.select(*USER_V1_COLUMNS)


def target_row_count(spark, sf_dir):
    """A2 on the target: SELECT COUNT(*) over the keyed table's view."""
    return keyed.row_count(keyed_latest(spark, sf_dir))


def row_count(spark, sf_dir):
    """A2: SELECT COUNT(*)."""
    return keyed.row_count(table(spark, sf_dir, "events"))


def word_count(spark, sf_dir):
    """Running word count, batch form, over documents."""
    return wordcount.word_counts(table(spark, sf_dir, "documents"), "text")


def word_count_conversations(spark, sf_dir):
    return wordcount.word_counts(table(spark, sf_dir, "conversations"), "text")


def _raw_profiles(spark, sf_dir):
    return derive.customer_raw_profiles(
        table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"),
        table(spark, sf_dir, "region"),
    )


def profile_reshape(spark, sf_dir):
    """Raw nested response -> flat user + reason."""
    return profile.reshape_profiles(
        _raw_profiles(spark, sf_dir), "raw", [F.lit("customer"), "c_custkey"]
    )


def profile_reshape_typed(spark, sf_dir):
    """P6 through `from_json` + `get(results, 0)` instead of the variant."""
    return profile.reshape_profiles_typed(
        _raw_profiles(spark, sf_dir), "raw", [F.lit("customer"), "c_custkey"]
    )


def sample_limit(spark, sf_dir):
    """L1, P5: SELECT id, first_name, last_name, email ... LIMIT 10 over the
    accepted users, ordered by id so the sample can be checked."""
    users = profile_reshape(spark, sf_dir)
    # Accepted rows sort first, so the first 10 by (rejected, id) hold the
    # first 10 accepted ones whenever there are 10.  Filtering after the
    # limit keeps the filter from being pushed under the reshape projection,
    # where it would parse every response a second time.
    top = keyed.sample_rows(
        users, ["id", "first_name", "last_name", "email", "reject_reason"], 10,
        order=[F.col("reject_reason").isNotNull(), F.col("id")],
    )
    return top.where(F.col("reject_reason").isNull()).drop("reject_reason")


# --- fixed values: run limits used on the events table ----------------------
RUN_LIMITS = RunLimits(max_errors=3, duration_seconds=86_400)
RUN_LIMITED_DURATION_SECONDS = 7 * 86_400
ARRIVALS = 4  # how often rows arrive; the query runs once after each
# ---------------------------------------------------------------------------


def run_stats(spark, sf_dir):
    """A3, A4: per run (user) sent / errors with the consecutive-error stop."""
    attempts = runs.attempts_from_events(table(spark, sf_dir, "events"))
    return runs.run_stats(attempts, RUN_LIMITS.max_errors)


def run_duration_cutoff(spark, sf_dir):
    """A5: the attempts made within the first day of each run."""
    attempts = runs.attempts_from_events(table(spark, sf_dir, "events"))
    return runs.within_duration(attempts, RUN_LIMITS.duration_seconds).select("run_id", "seq", "ok")


def run_stats_limited(spark, sf_dir):
    """A3-A5 together, as the producer loop applies them: duration first,
    then the streak cut-off over what is left."""
    attempts = runs.attempts_from_events(table(spark, sf_dir, "events"))
    kept = runs.within_duration(attempts, RUN_LIMITED_DURATION_SECONDS)
    return runs.run_stats(kept, RUN_LIMITS.max_errors)


def log_latency(spark, sf_dir):
    """JSON log lines -> parse -> latency per function."""
    lines = derive.event_log_lines(table(spark, sf_dir, "events"))
    return logs.latency_summary(logs.parse_logs(lines))


def enrich_dim(spark, sf_dir):
    """Events enriched with the customer segment, nation and region."""
    t = lambda n: table(spark, sf_dir, n)
    return enrich.enrich_events(t("events"), t("customer"), t("nation"), t("region"))


def daily_anomaly(spark, sf_dir):
    """Per type and day, event count and z-score."""
    return anomaly.daily_zscores(table(spark, sf_dir, "events"))


def keyed_stream_upsert(spark, sf_dir):
    """U1, T1, T2, T4, T5, S1f, X2: user messages (some faulty) arrive as
    envelope files; after each arrival the ingest query runs once into a
    keyed table (compacted on the way) and a dead-letter folder; result =
    the table's current view."""
    from tidewater.session import scratch_path
    from tidewater.sinks.keyed_table import KeyedTable
    from tidewater.sources.replay import read_envelopes
    from tidewater.streaming.ingest import start_ingest

    root = scratch_path(spark, "keyed_stream_upsert")
    env = derive.events_envelope(table(spark, sf_dir, "events"), derive.mixed_user_message())
    users = KeyedTable(spark, f"{root}/table", key="id", order=["timestamp", "partition", "offset"])

    def run_once():
        stream = read_envelopes(spark, f"{root}/landing", streaming=True)
        start_ingest(stream, users, f"{root}/dead_letters", f"{root}/checkpoint", available_now=True,
                     compact_every=3).awaitTermination()

    _arrive_in_parts(env, "offset", f"{root}/landing", run_once)
    return users.current().select(*USER_V1_COLUMNS)


def word_count_stream(spark, sf_dir):
    """Streaming word count in update mode into a keyed table
    (key = word, newest count wins), documents arrive in four parts."""
    from tidewater.session import scratch_path
    from tidewater.streaming.wordcount import start_word_count, word_count_table

    root = scratch_path(spark, "word_count_stream")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = word_count_table(spark, f"{root}/table")

    def run_once():
        lines = spark.readStream.schema(docs.schema).parquet(f"{root}/landing")
        start_word_count(lines, counts, f"{root}/checkpoint", text_col="text", available_now=True,
                         partitions=spark.sparkContext.defaultParallelism).awaitTermination()

    _arrive_in_parts(docs, "doc_id", f"{root}/landing", run_once)
    return counts.current().select("word", "count")


def _arrive_in_parts(df: DataFrame, number: str, path: str, run_once, parts: int = ARRIVALS) -> None:
    """Append `df` to `path` in `parts` parts dealt by `number`, each in the files
    that the reader's own splits make, running `run_once()` after each."""
    for k in range(parts):
        df.where(F.pmod(F.xxhash64(number), F.lit(parts)) == k).write.mode("append").parquet(path)
        run_once()


def _arrive_in_slices(df: DataFrame, path: str, run_once, slices: int = ARRIVALS) -> None:
    """Append `df` to `path` in `slices` time-ordered slices (cut at
    approximate quantiles of `ts`; rows without one come first), running `run_once()` after each, as if
    the data arrived in that order."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    probs = [i / slices for i in range(1, slices)]
    cuts = df.select(micros.alias("m")).approxQuantile("m", probs, 0.01)
    edges = [None, *cuts, None]
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = df
        if lo is not None:
            part = part.where(micros >= F.lit(int(lo)))
        if hi is not None:
            part = part.where((micros < F.lit(int(hi))) | (micros.isNull() if lo is None else F.lit(False)))
        part.write.mode("append").parquet(path)
        run_once()


def run_stats_stream(spark, sf_dir):
    """A3, A4 streaming form: attempts arrive in four time slices; after
    each arrival the query runs once (`availableNow`) on the same
    checkpoint and folds the new attempts into the per-run state."""
    from tidewater.schemas import ATTEMPTS
    from tidewater.session import scratch_path
    from tidewater.streaming.runs import run_state_table, run_stats_view, start_run_stats

    root = scratch_path(spark, "run_stats_stream")
    attempts = runs.attempts_from_events(table(spark, sf_dir, "events"))
    state = run_state_table(spark, f"{root}/state")

    def run_once():
        stream = spark.readStream.schema(ATTEMPTS).parquet(f"{root}/landing")
        start_run_stats(stream, state, f"{root}/checkpoint", RUN_LIMITS.max_errors,
                        available_now=True).awaitTermination()

    _arrive_in_slices(attempts, f"{root}/landing", run_once)
    return run_stats_view(state, RUN_LIMITS.max_errors)


def daily_counts_stream(spark, sf_dir):
    """X4 streaming form, T3/T6 with a watermark: events arrive in four time
    slices; a one-day tumbling window with a one-day watermark counts them
    per type in update mode into a keyed table (key = type and day, the
    newest count wins); z-scores are computed on the final counts."""
    from tidewater.session import scratch_path
    from tidewater.sinks.keyed_table import KeyedTable
    from tidewater.streaming.ingest import state_partitions, trigger_options

    root = scratch_path(spark, "daily_counts_stream")
    events = table(spark, sf_dir, "events").select("event_type", "ts")
    counts = KeyedTable(spark, f"{root}/counts", key=["event_type", "day"], order=["n"])

    def run_once():
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/landing")
        with state_partitions(spark, spark.sparkContext.defaultParallelism):
            q = (anomaly.streaming_daily_counts(stream).writeStream.outputMode("update")
                 .foreachBatch(lambda df, batch_id: counts.upsert(df, batch_id))
                 .option("checkpointLocation", f"{root}/checkpoint")
                 .trigger(**trigger_options(available_now=True)).start())
        q.awaitTermination()

    _arrive_in_slices(events, f"{root}/landing", run_once)
    return anomaly.zscores(counts.current())


def profile_landing_stream(spark, sf_dir):
    """S4 as files: raw responses land as text lines; a streaming query
    reads them (`readStream.text`), reshapes each, and appends the result
    to a parquet file sink (exactly once through the sink's log).  The id
    is derived from (landing file, text), so it is left out here."""
    from tidewater.session import scratch_path
    from tidewater.sources.landing import read_responses
    from tidewater.streaming.ingest import trigger_options

    root = scratch_path(spark, "profile_landing_stream")
    _raw_profiles(spark, sf_dir).select("raw").write.text(f"{root}/landing")
    raw = read_responses(spark, f"{root}/landing", streaming=True)
    users = profile.reshape_profiles(raw, "raw", ["source_path", "raw"]).drop("id")
    (users.writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**trigger_options(available_now=True)).start().awaitTermination())
    return spark.read.parquet(f"{root}/out")


def dead_letters(spark, sf_dir):
    """The rows the ingest query sets aside, with coordinates, raw
    value and reason; accepted ones go to the keyed table."""
    from tidewater.session import scratch_path
    from tidewater.sinks.keyed_table import KeyedTable
    from tidewater.sources.replay import read_envelopes, write_envelopes
    from tidewater.streaming.ingest import start_ingest

    root = scratch_path(spark, "dead_letters")
    env = derive.events_envelope(table(spark, sf_dir, "events"), derive.unfit_user_message())
    write_envelopes(env, f"{root}/landing")
    stream = read_envelopes(spark, f"{root}/landing", streaming=True)
    users = KeyedTable(spark, f"{root}/table", key="id", order=["timestamp", "partition", "offset"])
    start_ingest(stream, users, f"{root}/dead_letters", f"{root}/checkpoint",
                 available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{root}/dead_letters")
    return rows.select("partition", "offset", F.decode("raw_value", "UTF-8").alias("raw"), "reject_reason")


def keyed_two_writers(spark, sf_dir):
    """Two writers that both number their batch 0, a compaction, and a
    one-off write after it; nothing replaces or hides another's rows."""
    from tidewater.session import scratch_path
    from tidewater.sinks.keyed_table import KeyedTable

    users = KeyedTable(spark, scratch_path(spark, "keyed_two_writers"), key="id",
                       order=["timestamp", "partition", "offset"])
    events, kind = table(spark, sf_dir, "events"), F.col("event_type")

    def part(where):
        env = derive.events_envelope(events.where(where), derive.user_message())
        return decode.decode_envelope(env, USER_V1).select("timestamp", "partition", "offset", *USER_V1_COLUMNS)

    users.upsert(part(kind == "purchase"), 0, "first")
    users.upsert(part(kind == "view"), 0, "second")
    users.compact()
    users.upsert(part(~F.coalesce(kind.isin("purchase", "view"), F.lit(False))))
    return users.current().select(*USER_V1_COLUMNS)


def publish_envelopes(spark, sf_dir):
    """Landed responses -> accepted users -> messages -> decode."""
    from tidewater.session import scratch_path
    from tidewater.streaming.publish import publish_responses

    messages = publish_responses(_raw_profiles(spark, sf_dir), "raw", [F.lit("customer"), "c_custkey"],
                                 scratch_path(spark, "publish_envelopes"))
    return decode.decode_values(spark.read.parquet(messages), USER_V1)


def word_count_complete(spark, sf_dir):
    """The word count in complete mode; each batch replaces the result."""
    from tidewater.session import scratch_path
    from tidewater.streaming.wordcount import start_word_count_complete

    root = scratch_path(spark, "word_count_complete")
    docs = table(spark, sf_dir, "documents").select("text")
    lines = spark.readStream.schema(docs.schema).parquet(f"{sf_dir.rstrip('/')}/documents.parquet*")
    start_word_count_complete(lines, f"{root}/out", f"{root}/checkpoint", text_col="text", available_now=True,
                              partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return spark.read.parquet(f"{root}/out")


def catalog_target(spark, sf_dir):
    """Schema and table set up, the keyed view published into it,
    and the table read back with chosen columns."""
    from uuid import uuid4

    from tidewater import catalog
    from tidewater.session import scratch_path
    from tidewater.sources.tables import read_table

    target = TableSettings(table=f"created_users_{uuid4().hex[:12]}")
    catalog.setup_schema(spark, target, location=scratch_path(spark, "catalog_target"))
    catalog.publish_view(spark, keyed_latest(spark, sf_dir), target.schema, target.table)
    return read_table(spark, f"{target.schema}.{target.table}", ["id", "first_name", "last_name", "email"])


# --- fixed values: streams that arrive late ------------------------------------
LATE_SLICES = 2                      # the query runs once after each arrival
WEEK_SECONDS, DAY_SECONDS = 7 * 86_400, 86_400
SHORT_LATENESS_HOURS = 12            # too short for some attempts
SESSION_GAP_HOURS = 36
# ---------------------------------------------------------------------------


def _utc_attempts(spark, sf_dir):
    attempts = runs.attempts_from_events(table(spark, sf_dir, "events"))
    return attempts.withColumn("ts", anomaly.utc_instant("ts"))


def _after_all(rows: DataFrame, ts: str = "ts"):
    """A time far enough behind all of `rows` to close every slot and session."""
    from datetime import timedelta

    return rows.agg(F.max(ts)).first()[0] + timedelta(days=60)


def _late_runs(spark, sf_dir, name, slot_seconds, lateness):
    """Attempts arrive delayed and out of order; a heartbeat comes with the last."""
    from tidewater.schemas import ATTEMPTS
    from tidewater.session import scratch_path
    from tidewater.streaming.late_runs import heartbeats, start_late_run_stats

    root = scratch_path(spark, name)
    attempts = _utc_attempts(spark, sf_dir)
    parts = derive.arriving_slices(attempts, "ts", "seq", LATE_SLICES)
    parts[-1] = parts[-1].unionByName(heartbeats(spark, [_after_all(attempts)]))
    for part in parts:
        part.write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(ATTEMPTS).parquet(f"{root}/landing")
        start_late_run_stats(stream, f"{root}/out", f"{root}/checkpoint", RUN_LIMITS.max_errors, slot_seconds, lateness,
                             available_now=True, partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return attempts, f"{root}/out"


def run_stats_late(spark, sf_dir):
    """A4 as state per run: attempts up to three days late and out of order wait
    in slots until the watermark has passed; the result is that of all attempts."""
    from tidewater.streaming.late_runs import late_run_stats_view

    _, out = _late_runs(spark, sf_dir, "run_stats_late", WEEK_SECONDS, "3 days")
    return late_run_stats_view(spark, out, RUN_LIMITS.max_errors)


def late_attempts(spark, sf_dir):
    """Late data: the same with a watermark too short for some attempts.  Per run:
    the statistics of what came in time, and how many came too late;
    counted + late = arrived."""
    from tidewater.streaming.late_runs import late_run_stats_view, rejected_attempts

    attempts, out = _late_runs(spark, sf_dir, "late_attempts", DAY_SECONDS, f"{SHORT_LATENESS_HOURS} hours")
    stats = late_run_stats_view(spark, out, RUN_LIMITS.max_errors)
    late = rejected_attempts(spark, out).where("reason = 'late'").groupBy("run_id").agg(F.count(F.lit(1)).alias("late"))
    arrived = attempts.groupBy("run_id").agg(F.count(F.lit(1)).alias("arrived"))
    return (arrived.join(stats, "run_id", "left").join(late, "run_id", "left")
            .select("run_id", "arrived", F.coalesce("late", F.lit(0)).alias("late"), "messages_sent", "errors",
                    "longest_streak", "stopped"))


def dedup_stream(spark, sf_dir):
    """F8, streaming: every message is delivered twice, the second time up to three
    days later; the copies are recognised by the derived id."""
    from tidewater.schemas import ENVELOPE
    from tidewater.session import scratch_path
    from tidewater.streaming.dedup import start_dedup

    root = scratch_path(spark, "dedup_stream")
    events = table(spark, sf_dir, "events").withColumn("ts", anomaly.utc_instant("ts"))
    env = derive.events_envelope(events, F.col("event_type")).select(*ENVELOPE.fieldNames())
    once, again = (derive.arriving_slices(env, "timestamp", n, LATE_SLICES) for n in ("timestampType", "offset"))
    for part, copies in zip(once, again):
        part.unionByName(copies).write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(ENVELOPE).parquet(f"{root}/landing")
        start_dedup(stream, f"{root}/out", f"{root}/checkpoint", "4 days", available_now=True,
                    partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return out.select(F.col("message_id").alias("id"), "offset", F.decode("value", "UTF-8").alias("event_type"))


def attempt_sessions(spark, sf_dir):
    """Session windows over attempts that arrive late and out of order: the runs of a
    user when no run id is given."""
    from tidewater.schemas import ATTEMPTS
    from tidewater.session import scratch_path
    from tidewater.streaming.late_runs import heartbeats
    from tidewater.streaming.sessions import start_sessions

    root = scratch_path(spark, "attempt_sessions")
    attempts = _utc_attempts(spark, sf_dir)
    parts = derive.arriving_slices(attempts, "ts", "seq", LATE_SLICES)
    parts[-1] = parts[-1].unionByName(heartbeats(spark, [_after_all(attempts)]))
    for part in parts:
        part.write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(ATTEMPTS).parquet(f"{root}/landing")
        start_sessions(stream, f"{root}/out", f"{root}/checkpoint", f"{SESSION_GAP_HOURS} hours", "3 days",
                       available_now=True, partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    rows = spark.read.parquet(f"{root}/out").where("run_id is not null")
    return rows.select("run_id", F.unix_micros("started").alias("started_us"), F.unix_micros("last_attempt").alias("last_us"),
                       "attempts", "messages_sent", "errors")


def publish_confirmed(spark, sf_dir):
    """U3's waiting time as a stream-stream join: each attempt with the confirmation
    that came within ten seconds; attempts without one are errors."""
    from datetime import timedelta

    from tidewater.session import scratch_path
    from tidewater.streaming.confirm import start_confirmed

    root = scratch_path(spark, "publish_confirmed")
    attempts = _utc_attempts(spark, sf_dir)
    events = table(spark, sf_dir, "events").where("event_type <> 'error'")
    delay = F.floor(F.col("value") * 200_000).cast("long")  # a fifth of the value, in seconds
    confirmations = events.select(F.col("event_id").alias("seq"), F.timestamp_micros(
        F.unix_micros(anomaly.utc_instant("ts")) + delay).alias("confirmed_at"))
    end = _after_all(attempts)
    first = derive.arriving_slices(attempts.drop("ok"), "ts", "seq", LATE_SLICES)
    second = derive.arriving_slices(confirmations, "confirmed_at", "seq", LATE_SLICES)
    # heartbeats; an inner side's rows without a key never reach its watermark, so that one has a number
    first[-1] = first[-1].unionByName(spark.createDataFrame([(None, None, end)], first[-1].schema))
    second[-1] = second[-1].unionByName(spark.createDataFrame([(-1, end + timedelta(days=1))], second[-1].schema))
    for a, c in zip(first, second):
        a.write.mode("append").parquet(f"{root}/attempts")
        c.write.mode("append").parquet(f"{root}/confirmations")
        start_confirmed(spark.readStream.schema(a.schema).parquet(f"{root}/attempts"),
                        spark.readStream.schema(c.schema).parquet(f"{root}/confirmations"), f"{root}/out",
                        f"{root}/checkpoint", lateness="11 days", available_now=True,
                        partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return spark.read.parquet(f"{root}/out").where("seq is not null").select("run_id", "seq", "ok")


def word_count_state(spark, sf_dir):
    """The state of a finished word count, read back from its checkpoint."""
    from tidewater.session import scratch_path
    from tidewater.streaming.audit import state_rows
    from tidewater.streaming.wordcount import start_word_count_complete

    root = scratch_path(spark, "word_count_state")
    docs = table(spark, sf_dir, "documents").select("text")
    lines = spark.readStream.schema(docs.schema).parquet(f"{sf_dir.rstrip('/')}/documents.parquet*")
    start_word_count_complete(lines, f"{root}/out", f"{root}/checkpoint", text_col="text", available_now=True,
                              partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return state_rows(spark, f"{root}/checkpoint").select("word", "count")


def daily_baseline_stream(spark, sf_dir):
    """X4 incremental: days close with the watermark and are scored against the days
    before them, from three sums per type kept as state."""
    from tidewater.session import scratch_path
    from tidewater.streaming.baseline import scores_view, start_daily_scores

    root = scratch_path(spark, "daily_baseline_stream")
    events = table(spark, sf_dir, "events").select("event_type", "ts", "event_id").withColumn("at", anomaly.utc_instant("ts"))
    parts = [p.select("event_type", "ts") for p in derive.arriving_slices(events, "at", "event_id", LATE_SLICES)]
    # the newest day's own window never closes, so a far event only moves the watermark
    far = spark.createDataFrame([("", _after_all(events))], parts[-1].schema)
    parts[-1] = parts[-1].unionByName(far)
    for part in parts:
        part.write.mode("append").parquet(f"{root}/landing")
        start_daily_scores(spark.readStream.schema(part.schema).parquet(f"{root}/landing"), f"{root}/out",
                           f"{root}/checkpoint", lateness="4 days", available_now=True,
                           partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return scores_view(spark.read.parquet(f"{root}/out"))


def latency_sketch(spark, sf_dir):
    """A6 mergeable: KLL sketches per function and hour, merged on read.  `near` says
    that the merged median's rank is within the sketch's error of a half."""
    from tidewater.operators import sketches

    parsed = logs.parse_logs(derive.event_log_lines(table(spark, sf_dir, "events")))
    merged = sketches.merged_sketches(sketches.latency_sketches(parsed), "function_name")
    medians = sketches.quantiles(merged, p50=0.5).select(F.col("function_name").alias("_fn"), "calls", "parts", "p50")
    # null-safe: a plain join would filter for a name below the parse, and parse twice
    same = F.col("function_name").eqNullSafe(F.col("_fn"))
    ranks = parsed.select("function_name", "latency_s").join(medians, same).groupBy("function_name").agg(
        F.first("calls").alias("calls"), F.first("parts").alias("hours"),
        F.sum(F.when(F.col("latency_s") < F.col("p50"), 1).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("latency_s") <= F.col("p50"), 1).otherwise(0)).alias("upto"))
    e = 2 * sketches.RANK_ERROR  # an interval that holds the true median's rank has two sides
    near = (F.col("below") <= (0.5 + e) * F.col("calls")) & (F.col("upto") >= (0.5 - e) * F.col("calls"))
    return ranks.select("function_name", "calls", "hours", near.alias("near"))


def heavy_words(spark, sf_dir):
    """A1 without growing state: the 100 most frequent words from a bounded summary."""
    from tidewater.operators import sketches

    return sketches.heavy_words(table(spark, sf_dir, "documents"), "text", 100)


def enrich_filtered(spark, sf_dir):
    """X3, filter and enrichment: large purchases and sign-ups with their dimensions."""
    t = lambda n: table(spark, sf_dir, n)
    wanted = F.col("event_type").isin("purchase", "signup") & (F.col("value") >= 50)
    return enrich.enrich_events(t("events"), t("customer"), t("nation"), t("region"), wanted)


QUERIES: dict[str, Query] = {
    "daily_baseline_stream": daily_baseline_stream,
    "latency_sketch": latency_sketch,
    "heavy_words": heavy_words,
    "enrich_filtered": enrich_filtered,
    "run_stats_late": run_stats_late,
    "late_attempts": late_attempts,
    "dedup_stream": dedup_stream,
    "attempt_sessions": attempt_sessions,
    "publish_confirmed": publish_confirmed,
    "word_count_state": word_count_state,
    "dead_letters": dead_letters,
    "keyed_two_writers": keyed_two_writers,
    "publish_envelopes": publish_envelopes,
    "word_count_complete": word_count_complete,
    "catalog_target": catalog_target,
    "json_decode_flatten": json_decode_flatten,
    "envelope_roundtrip": envelope_roundtrip,
    "decode_reject": decode_reject,
    "decode_permissive": decode_permissive,
    "derived_id": derived_ids,
    "keyed_latest": keyed_latest,
    "row_count": row_count,
    "target_row_count": target_row_count,
    "word_count": word_count,
    "word_count_conversations": word_count_conversations,
    "profile_reshape": profile_reshape,
    "profile_reshape_typed": profile_reshape_typed,
    "sample_limit": sample_limit,
    "run_stats": run_stats,
    "run_duration_cutoff": run_duration_cutoff,
    "run_stats_limited": run_stats_limited,
    "log_latency": log_latency,
    "enrich_dim": enrich_dim,
    "daily_anomaly": daily_anomaly,
    "keyed_stream_upsert": keyed_stream_upsert,
    "word_count_stream": word_count_stream,
    "run_stats_stream": run_stats_stream,
    "profile_landing_stream": profile_landing_stream,
    "daily_counts_stream": daily_counts_stream,
}
