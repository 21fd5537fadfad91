"""Message streams derived by Spark from the given tables.

The given tables hold no Kafka topic, API response or log file, so the
queries derive them: every `events` row becomes one message on a topic, every
`customer` row one raw API response, and so on.  All derivations are
column expressions over the whole table, so their work grows with it.

The SQL twins in `plans.oracle` derive the same rows in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.codec import encode_utf8, message_json
from tidewater.functions.latency import format_latency
from tidewater.schemas import DEFAULT_TOPIC, MESSAGE_KEYS

# --- fixed values of the derivation (mirrored in plans.oracle) -------------
TOPIC_PARTITIONS = 4          # events are spread over 4 topic partitions by user
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
EVENT_MESSAGE_KEYS = ("event_id", "ts", "user_id", "event_type", "value", "props")
DELAY_SECONDS = 3 * 86_400    # messages arrive up to three days after they were made
DELAY_STEP = 7919             # by this many seconds per number
# ---------------------------------------------------------------------------


def iso_text(ts) -> Column:
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, ISO_MICROS)


def events_envelope(events: DataFrame, payload: Column, topic: str = DEFAULT_TOPIC) -> DataFrame:
    """One envelope per event: keyless, partition chosen by user, offset =
    event id, broker timestamp = event time."""
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        encode_utf8(payload).alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.col("user_id"), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def event_message() -> Column:
    """The event itself as a flat JSON message of text fields."""
    return message_json(
        EVENT_MESSAGE_KEYS, {"ts": iso_text("ts")}
    )


def user_message_fields() -> dict:
    """A user record per event: the event's user is the record key."""
    return {
        "id": F.col("user_id").cast("string"),
        "first_name": F.col("event_type"),
        "last_name": F.col("event_id").cast("string"),
        "gender": F.lit(None).cast("string"),
        "address": F.col("props"),
        "post_code": F.col("user_id").cast("string"),
        "email": F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.com")),
        "username": F.concat(F.lit("u"), F.col("user_id").cast("string")),
        "dob": iso_text("ts"),
        "registered_date": iso_text("ts"),
        "phone": F.col("value").cast("string"),
        "picture": F.lit(None).cast("string"),
    }


def user_message() -> Column:
    return message_json(MESSAGE_KEYS, user_message_fields())


def mixed_user_message() -> Column:
    """User messages with faults chosen by event type, for the dead-letter
    path: purchase and signup are valid (signup without `dob`), view lacks
    the required `email`, click is cut short (not JSON), error is empty."""
    fields = user_message_fields()
    full = message_json(MESSAGE_KEYS, fields)
    no_dob = message_json([k for k in MESSAGE_KEYS if k != "dob"], fields)
    no_email = message_json([k for k in MESSAGE_KEYS if k != "email"], fields)
    kind = F.col("event_type")
    return (
        F.when(kind == "purchase", full)
        .when(kind == "signup", no_dob)
        .when(kind == "view", no_email)
        .when(kind == "click", F.left(full, F.length(full) - 1))
        .otherwise(F.lit(""))
    )


def unfit_user_message() -> Column:
    """`mixed_user_message` with format faults as well: a purchase of under 25
    has an e-mail without its @, a signup of under 25 an empty id, and an
    error only white space."""
    fields = user_message_fields()
    name = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    low, kind = F.col("value") < 25, F.col("event_type")
    return (
        F.when((kind == "purchase") & low, message_json(MESSAGE_KEYS, {**fields, "email": name}))
        .when((kind == "signup") & low, message_json(MESSAGE_KEYS, {**fields, "id": F.lit("")}))
        .when(kind == "error", F.lit("\t\n "))
        .otherwise(mixed_user_message())
    )


def customer_raw_profiles(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One raw API response per customer, as JSON text in column `raw`.

    Shapes vary with the data so every reshape rule is exercised: the post
    code is a JSON number in even regions and text elsewhere; HOUSEHOLD
    customers lack the `email` key; a negative balance gives a null gender
    (accepted); a balance over 9000 a null city (rejected); a balance in
    [0, 50) an empty result list; one in [50, 60) text cut short.
    """
    from tidewater.operators.joins import join_dimension

    j = join_dimension(
        join_dimension(customer, nation, customer.c_nationkey == nation.n_nationkey),
        region, F.col("n_regionkey") == region.r_regionkey,
    )
    first = F.split(F.col("c_name"), "#").getItem(0)
    last = F.split(F.col("c_name"), "#").getItem(1)
    key = F.col("c_custkey").cast("string")
    gender = (
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
        .when(F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"), F.lit("male"))
        .otherwise(F.lit("female"))
    )
    city = F.when(F.col("c_acctbal") > 9000, F.lit(None).cast("string")).otherwise(F.col("n_name"))

    person = F.struct(
        gender.alias("gender"),
        F.struct(first.alias("first"), last.alias("last")).alias("name"),
        F.struct(
            F.struct(F.col("c_custkey").alias("number"),
                     F.concat(F.col("c_mktsegment"), F.lit(" St")).alias("name")).alias("street"),
            city.alias("city"),
            F.col("r_name").alias("state"),
            F.col("n_name").alias("country"),
            F.concat(F.lit("P"), key).alias("postcode"),
        ).alias("location"),
        F.concat(F.lower(first), F.lit("."), last, F.lit("@example.com")).alias("email"),
        F.struct(F.concat(F.lit("user"), key).alias("username")).alias("login"),
        F.struct(F.concat((F.col("c_nationkey") + 1950).cast("string"),
                          F.lit("-01-15T00:00:00.000Z")).alias("date")).alias("dob"),
        F.struct(F.concat((F.col("n_regionkey") + 2000).cast("string"),
                          F.lit("-06-30T12:00:00.000Z")).alias("date")).alias("registered"),
        F.concat(F.lit("+"), F.col("c_nationkey").cast("string"), F.lit("-"), key).alias("phone"),
        F.struct(F.concat(F.lit("https://img.example/"), key, F.lit(".jpg")).alias("medium")).alias("picture"),
    )
    # Each step is its own projection: a CASE that refers to the step before
    # twice would otherwise copy the whole to_json tree into every branch.
    steps = j.select(
        "c_custkey", "c_acctbal", "c_mktsegment", "n_regionkey",
        F.to_json(F.struct(F.array(person).alias("results")),
                  {"ignoreNullFields": "false"}).alias("body"),
    )
    body = F.col("body")
    # Even regions: the post code becomes the JSON number key * 10 + 7.
    steps = steps.withColumn("body", F.when(
        F.col("n_regionkey").isin(0, 2, 4),
        F.regexp_replace(body, r'"postcode":"P[0-9]+"',
                         F.concat(F.lit('"postcode":'), (F.col("c_custkey") * 10 + 7).cast("string"))),
    ).otherwise(body))
    # HOUSEHOLD customers: the `email` key is left out.
    steps = steps.withColumn("body", F.when(
        F.col("c_mktsegment") == "HOUSEHOLD", F.regexp_replace(body, r',"email":"[^"]*"', "")
    ).otherwise(body))
    bal = F.col("c_acctbal")
    raw = (
        F.when((bal >= 0) & (bal < 50), F.lit('{"results": []}'))
        .when((bal >= 50) & (bal < 60), F.left(body, F.lit(40)))
        .otherwise(body)
    )
    return steps.select("c_custkey", raw.alias("raw"))


def event_log_lines(events: DataFrame) -> DataFrame:
    """One latency log line per event: the function is the event type, the
    latency is value / 10 seconds (three decimals, no rounding needed since
    values carry two), errors are logged at ERROR level."""
    from tidewater.operators.logs import LOG_TIME_FORMAT, log_line

    latency = format_latency(F.col("value") / 10)
    line = log_line({
        "timestamp": F.date_format("ts", LOG_TIME_FORMAT),
        "level": F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO"),
        "item_id": F.col("event_id").cast("string"),
        "message": F.concat(F.lit("Latency: "), F.col("event_type"), F.lit(" completed in "), latency),
        "user_id": F.col("user_id").cast("string"),
        "request_payload": F.from_json(F.col("props"), "map<string,int>"),
        "function_name": F.col("event_type"),
        "latency": latency,
    })
    return events.select(line.alias("value"))


def arriving_slices(rows: DataFrame, ts: str, number: str, slices: int) -> list[DataFrame]:
    """`rows` as they arrive: each up to `DELAY_SECONDS` after its time, by its
    number; cut into `slices` equal stretches of arrival time.  Rows without a
    time or number arrive first."""
    at = F.unix_micros(ts) + F.pmod(F.col(number) * DELAY_STEP, F.lit(DELAY_SECONDS)) * 1_000_000
    timed = rows.withColumn("_at", at)
    lo, hi = timed.agg(F.min("_at"), F.max("_at")).first()
    part = F.coalesce(F.call_function("div", (F.col("_at") - F.lit(lo or 0)) * slices, F.lit((hi or 0) - (lo or 0) + 1)), F.lit(0))
    return [timed.where(part == k).drop("_at") for k in range(slices)]
