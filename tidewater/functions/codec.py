"""Payload encoding and decoding.

`decode_text` and `parse_fixed` are the consumer side (bytes -> text ->
struct); `message_json` and `encode_utf8` the producer side (columns -> JSON
text -> bytes).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.schemas import CORRUPT_COLUMN


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def decode_text(value="value") -> Column:
    """CAST(value AS STRING): bytes read as UTF-8, invalid bytes kept as is
    (check them with `is_valid_utf8`)."""
    return _c(value).cast("string")


def encode_utf8(text) -> Column:
    return F.encode(_c(text), "UTF-8")


def parse_fixed(text, schema: StructType, corrupt_column: str | None = CORRUPT_COLUMN) -> Column:
    """`from_json` in PERMISSIVE mode against a fixed schema.

    Unknown keys are dropped, a duplicate key keeps the last value, scalars
    of other JSON types come back as their text.  With `corrupt_column` the
    struct gains that string field, filled with the raw text when the
    record could not be parsed as one JSON object.
    """
    options = {"mode": "PERMISSIVE"}
    if corrupt_column:
        schema = StructType(list(schema.fields) + [StructField(corrupt_column, StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_column
    return F.from_json(_c(text), schema, options)


def message_json(keys: Iterable[str], source: dict | None = None) -> Column:
    """One JSON object per row with `keys` in the given order, every value
    as text, nulls kept as JSON null (Spark drops null fields unless told
    not to).  `source` maps a key to a column when the names differ."""
    source = source or {}
    fields = [_c(source.get(k, k)).cast("string").alias(k) for k in keys]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
