"""Envelope decoding with validation and dead-lettering.

`decode_values` is the plain consumer transform: CAST(value AS STRING) ->
`from_json` with a fixed schema -> `data.*`.  It keeps Spark's PERMISSIVE
behaviour, so a malformed message becomes an all-null row.

`decode_envelope` does the same parse exactly once per record and adds a
`reject_reason` column (null = accepted), so a caller can route accepted rows
to the table and the rest, with their raw bytes and coordinates, to a
dead-letter table.  Split with `accepted` / `rejected` after persisting the
decoded batch (see `sinks.keyed_table.write_split`): a filter placed on the
parse output would otherwise be pushed below the projection and parse twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.functions.codec import decode_text, parse_fixed
from tidewater.schemas import CORRUPT_COLUMN, ENVELOPE_COORDS, USER_REQUIRED, USER_V1

# --- fixed values: reject reasons, in the order they are tested ------------
REASON_EMPTY = "empty"
REASON_ENCODING = "bad_encoding"
REASON_CORRUPT = "corrupt"
REASON_MISSING = "missing_required"
REASON_FORMAT = "bad_format"
REASONS = (REASON_EMPTY, REASON_ENCODING, REASON_CORRUPT, REASON_MISSING, REASON_FORMAT)
BLANK = r"^\s*$"
FORMATS = {"id": r"\S", "username": r"\S", "email": r"^[^@\s]+@[^@\s]+$"}  # what a required field must match
# ---------------------------------------------------------------------------


def decode_values(raw: DataFrame, schema: StructType = USER_V1) -> DataFrame:
    """Reference-compatible transform: 11 string columns, nothing else."""
    return (
        raw.select(decode_text("value").alias("json_value"))
        .select(parse_fixed(F.col("json_value"), schema, corrupt_column=None).alias("data"))
        .select("data.*")
    )


def reject_reason(text: Column, data: Column, required: Sequence[str]) -> Column:
    missing = unfit = F.lit(False)
    for name in required:
        missing = missing | data[name].isNull()
        if name in FORMATS:
            unfit = unfit | ~data[name].rlike(FORMATS[name])
    return (
        F.when(text.isNull() | text.rlike(BLANK), F.lit(REASON_EMPTY))
        .when(~F.is_valid_utf8(text), F.lit(REASON_ENCODING))
        .when(data[CORRUPT_COLUMN].isNotNull(), F.lit(REASON_CORRUPT))
        .when(missing, F.lit(REASON_MISSING))
        .when(unfit, F.lit(REASON_FORMAT))
    )


def decode_envelope(
    env: DataFrame,
    schema: StructType = USER_V1,
    required: Sequence[str] = USER_REQUIRED,
    keep: Sequence[str] = ENVELOPE_COORDS,
) -> DataFrame:
    """Columns: `keep` coordinates, the schema fields, `reject_reason`, and
    the raw bytes as `raw_value` (for the dead-letter table)."""
    keep = [c for c in keep if c in env.columns]
    parsed = env.select(
        *keep,
        F.col("value").alias("raw_value"),
        parse_fixed(decode_text("value"), schema).alias("_data"),
    )
    text = decode_text("raw_value")
    return parsed.select(
        *keep,
        *[F.col("_data")[f.name].alias(f.name) for f in schema.fields],
        reject_reason(text, F.col("_data"), required).alias("reject_reason"),
        "raw_value",
    )


def accepted(decoded: DataFrame, schema: StructType = USER_V1,
             keep: Sequence[str] = ENVELOPE_COORDS) -> DataFrame:
    keep = [c for c in keep if c in decoded.columns]
    return decoded.where(F.col("reject_reason").isNull()).select(
        *keep, *[f.name for f in schema.fields]
    )


def rejected(decoded: DataFrame, keep: Sequence[str] = ENVELOPE_COORDS) -> DataFrame:
    """Dead-letter rows: coordinates, raw bytes, reason."""
    keep = [c for c in keep if c in decoded.columns]
    return decoded.where(F.col("reject_reason").isNotNull()).select(
        *keep, "raw_value", "reject_reason"
    )
