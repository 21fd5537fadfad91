"""Property tests against plain Python semantics."""

import json
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.functions.codec import encode_utf8, message_json
from tidewater.operators import decode
from tidewater.operators.wordcount import word_counts
from tidewater.schemas import MESSAGE_KEYS, USER_V1, USER_V1_COLUMNS

text = st.one_of(st.none(), st.text(max_size=12))
record = st.fixed_dictionaries({k: text for k in MESSAGE_KEYS})


@settings(max_examples=10, deadline=None)
@given(st.lists(record, min_size=1, max_size=20))
def test_message_roundtrip_keeps_every_field(spark, recs):
    schema = ", ".join(f"`{k}` string" for k in MESSAGE_KEYS)
    df = spark.createDataFrame([tuple(r[k] for k in MESSAGE_KEYS) for r in recs], schema)
    env = df.select(encode_utf8(message_json(MESSAGE_KEYS)).alias("value"),
                    F.monotonically_increasing_id().alias("offset"))
    out = decode.decode_envelope(env, USER_V1, keep=("offset",)).orderBy("offset").collect()
    raw = {e["offset"]: bytes(e["value"]) for e in env.collect()}
    for r, row in zip(recs, out):
        assert [row[c] for c in USER_V1_COLUMNS] == [r[c] for c in USER_V1_COLUMNS]
        required_missing = any(r[c] is None for c in ("id", "first_name", "last_name",
                                                      "email", "username"))
        assert (row["reject_reason"] == "missing_required") == required_missing
        # the producer's own encoding parses to the same object
        assert json.loads(raw[row["offset"]].decode("utf-8")) == r


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=15), min_size=1, max_size=20))
def test_word_count_equals_python_split(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r.word: r["count"] for r in word_counts(df).collect()}
    want = Counter(w for x in lines for w in x.split(" "))
    assert got == dict(want)
