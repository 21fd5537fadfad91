"""Fixed schemas of the data model.

Field names and orders below are fixed values: they must equal the message
body the producer writes, the table the consumer fills, the Kafka source
envelope, and the 17-key JSON log record.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values -----------------------------------------------------------
# Message body keys, in the order the producer serialises them.
MESSAGE_KEYS = (
    "id", "first_name", "last_name", "gender", "address", "post_code",
    "email", "username", "dob", "registered_date", "phone", "picture",
)
# Columns of the target table (the consumer's schema drops `dob`).
USER_V1_COLUMNS = (
    "id", "first_name", "last_name", "gender", "address", "post_code",
    "email", "username", "registered_date", "phone", "picture",
)
# Fields declared non-nullable by the consumer; we enforce them.
USER_REQUIRED = ("id", "first_name", "last_name", "email", "username")
# Keys of one JSON log record, in emission order.
LOG_KEYS = (
    "timestamp", "level", "item_id", "message", "user_id",
    "conversation_session_id", "platform", "language", "request_payload",
    "response_payload", "function_name", "input_data", "error_details",
    "status", "latency", "environment", "logger_name",
)
# Default topic, keyspace and table names.
DEFAULT_TOPIC = "users_created"
DEFAULT_SCHEMA = "spark_streams"
DEFAULT_TABLE = "created_users"
# ---------------------------------------------------------------------------

CORRUPT_COLUMN = "_corrupt_record"


def _strings(names, required=()) -> StructType:
    return StructType(
        [StructField(n, StringType(), nullable=n not in required) for n in names]
    )


USER_V1 = _strings(USER_V1_COLUMNS, USER_REQUIRED)
USER_V2 = _strings(MESSAGE_KEYS, USER_REQUIRED)

# Public schema of Spark's Kafka source.
ENVELOPE = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)
# Coordinates that identify one message and order writes to one key.
ENVELOPE_COORDS = ("topic", "partition", "offset", "timestamp")

LOG = _strings(LOG_KEYS)

ATTEMPTS = StructType(
    [
        StructField("run_id", LongType()),
        StructField("seq", LongType()),
        StructField("ts", TimestampType()),
        StructField("ok", BooleanType()),
    ]
)

# Raw API response, typed form (the variant path in operators.profile does
# not need it; it is kept for the from_json form and for producers).
_leaf = lambda *names: StructType([StructField(n, StringType()) for n in names])
RAW_PROFILE = StructType(
    [
        StructField(
            "results",
            ArrayType(
                StructType(
                    [
                        StructField("gender", StringType()),
                        StructField("name", _leaf("first", "last")),
                        StructField(
                            "location",
                            StructType(
                                [
                                    StructField("street", _leaf("number", "name")),
                                    StructField("city", StringType()),
                                    StructField("state", StringType()),
                                    StructField("country", StringType()),
                                    StructField("postcode", StringType()),
                                ]
                            ),
                        ),
                        StructField("email", StringType()),
                        StructField("login", _leaf("username")),
                        StructField("dob", _leaf("date")),
                        StructField("registered", _leaf("date")),
                        StructField("phone", StringType()),
                        StructField("picture", _leaf("medium")),
                    ]
                )
            ),
        )
    ]
)
