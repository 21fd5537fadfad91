"""Golden edge cases of the one-pass decode (PERMISSIVE from_json + reasons)."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators import decode
from tidewater.schemas import USER_V1, USER_V1_COLUMNS

FULL = ('{"id":"1","first_name":"A","last_name":"B","gender":"f","address":"x",'
        '"post_code":"p","email":"e@x","username":"u","dob":"d","registered_date":"r",'
        '"phone":"ph","picture":"pic"}')
REQ = '"first_name":"A","last_name":"B","email":"e@x","username":"u"'

CASES = [
    (FULL, None, "1"),
    ('{"id":"1",', "corrupt", None),
    ("hello", "corrupt", None),
    ("5", "corrupt", None),
    ("null", "corrupt", None),
    ('[{"id":"9"},{"id":"10"}]', "corrupt", None),
    ("", "empty", None),
    (None, "empty", None),
    ('{"id":"2"}', "missing_required", "2"),
    ('{"ID":"1"}', "missing_required", None),
    ('{"id":null,' + REQ + '}', "missing_required", None),
    ('{"id":3,' + REQ + '}', None, "3"),
    ('{"id":"1","id":"2",' + REQ + '}', None, "2"),
    (FULL + " junk", None, "1"),
]


def envelope(spark, payloads):
    rows = [(None if p is None else bytearray(p.encode("utf-8")) if isinstance(p, str) else p, i)
            for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "value binary, offset long")


def test_reasons_and_values(spark):
    env = envelope(spark, [c[0] for c in CASES])
    out = decode.decode_envelope(env, USER_V1, keep=("offset",)).orderBy("offset").collect()
    for (payload, reason, ident), row in zip(CASES, out):
        assert row["reject_reason"] == reason, payload
        assert row["id"] == ident, payload


def test_bad_utf8_is_rejected(spark):
    env = envelope(spark, [bytearray(b'\xff\x61')])
    row = decode.decode_envelope(env, USER_V1, keep=("offset",)).first()
    assert row["reject_reason"] == "bad_encoding"
    assert bytes(row["raw_value"]) == b"\xff\x61"


def test_conservation_and_split(spark):
    env = envelope(spark, [c[0] for c in CASES])
    d = decode.decode_envelope(env, USER_V1, keep=("offset",)).cache()
    good = decode.accepted(d, keep=("offset",))
    bad = decode.rejected(d, keep=("offset",))
    assert good.count() + bad.count() == len(CASES)
    assert good.columns == ["offset", *USER_V1_COLUMNS]
    assert bad.columns == ["offset", "raw_value", "reject_reason"]


def test_reference_transform_keeps_permissive_rows(spark):
    env = envelope(spark, [FULL, "hello"])
    out = decode.decode_values(env)
    assert out.columns == list(USER_V1_COLUMNS)
    rows = out.collect()
    assert rows[0]["id"] == "1" and all(v is None for v in rows[1])


def test_one_parse_per_record(spark):
    env = envelope(spark, [FULL])
    d = decode.decode_envelope(env, USER_V1)
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_format_rules(spark):
    rest = '"first_name":"A","last_name":"B"'
    cases = {
        '{"id":"",' + REQ + '}': "bad_format",
        '{"id":"1","email":"not-an-email","username":"u",' + rest + '}': "bad_format",
        '{"id":"1","email":"a b@x","username":"u",' + rest + '}': "bad_format",
        '{"id":"1","email":"e@x","username":" ",' + rest + '}': "bad_format",
        "\t\n": "empty",
        '{"id":"1",' + REQ + '}': None,
    }
    out = decode.decode_envelope(envelope(spark, list(cases)), USER_V1, keep=("offset",)).orderBy("offset").collect()
    assert [r["reject_reason"] for r in out] == list(cases.values())
