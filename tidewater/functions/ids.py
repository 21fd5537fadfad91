"""Deterministic record ids.

A random id per attempt turns a retried message into a new record, and
Spark's `uuid()` yields different values when a failed task is retried.
Ids here are the MD5 of stable source coordinates, laid out 8-4-4-4-12 so
they read like the UUIDs they replace (they are not version-4 UUIDs).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uuid_layout(hex32: Column) -> Column:
    return F.concat_ws(
        "-",
        F.substring(hex32, 1, 8),
        F.substring(hex32, 9, 4),
        F.substring(hex32, 13, 4),
        F.substring(hex32, 17, 4),
        F.substring(hex32, 21, 12),
    )


def derived_id(*coords) -> Column:
    """Id from coordinates such as (topic, partition, offset) of an
    envelope, or (landing path, raw text) of a landed response."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in coords]
    # each part with its length before it, a null as "-": no two coordinate
    # lists share an encoding
    coded = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return uuid_layout(F.md5(F.concat(*coded)))
