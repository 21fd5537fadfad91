"""Column-level building blocks (all JVM-side built-ins, no Python UDFs)."""

from tidewater.functions.codec import decode_text, encode_utf8, message_json, parse_fixed
from tidewater.functions.ids import derived_id, uuid_layout
from tidewater.functions.latency import format_latency, latency_seconds
from tidewater.functions.text import split_words

__all__ = [
    "decode_text", "encode_utf8", "message_json", "parse_fixed",
    "derived_id", "uuid_layout", "format_latency", "latency_seconds", "split_words",
]
