import json
import re

from pyspark.sql import functions as F

from tidewater.functions import derived_id, latency_seconds, message_json, split_words


def test_split_keeps_empty_tokens(spark):
    df = spark.createDataFrame([("a  b ",), ("",), (None,)], "value string")
    got = [r[0] for r in df.select(split_words("value")).collect()]
    assert got == [["a", "", "b", ""], [""], None]


def test_message_json_keeps_nulls_and_order(spark):
    df = spark.createDataFrame([("1", None, 5)], "id string, gender string, n int")
    text = df.select(message_json(["id", "gender", "n"])).first()[0]
    assert list(json.loads(text).items()) == [("id", "1"), ("gender", None), ("n", "5")]


def test_derived_id_is_stable_and_uuid_shaped(spark):
    df = spark.createDataFrame([("t", 0, 5), ("t", 0, 5), ("t", 1, 5)], "topic string, p int, o long")
    ids = [r[0] for r in df.select(derived_id("topic", "p", "o")).collect()]
    assert ids[0] == ids[1] != ids[2]
    assert re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", ids[0])


def test_latency_parse(spark):
    df = spark.createDataFrame([("0.123s",), ("",), ("abc",), ("12s",), (None,)], "l string")
    got = [r[0] for r in df.select(latency_seconds("l")).collect()]
    assert got == [0.123, None, None, 12.0, None]
