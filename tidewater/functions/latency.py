"""Latency text as written by the JSON logger: seconds with three decimals
and an `s` suffix, e.g. `0.123s`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LATENCY_PATTERN = r"^([0-9]+(?:\.[0-9]+)?)s$"


def latency_seconds(text) -> Column:
    """`0.123s` -> 0.123; empty or malformed text -> null (never an error)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract(col, LATENCY_PATTERN, 1).try_cast("double")


def format_latency(seconds) -> Column:
    col = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.format_string("%.3fs", col)
