"""Raw nested profile -> flat user (cases of FIXTURES §1)."""

import json

from pyspark.sql import functions as F

from tidewater.operators.profile import reshape_profiles


def person(**over):
    p = {
        "gender": "female",
        "name": {"first": "Ann", "last": "Lee"},
        "location": {"street": {"number": 8929, "name": "Valwood Pkwy"}, "city": "C",
                     "state": "S", "country": "US", "postcode": 63104},
        "email": "ann@x", "login": {"username": "ann"}, "dob": {"date": "1990"},
        "registered": {"date": "2010"}, "phone": "1", "picture": {"medium": "m"},
    }
    for k, v in over.items():
        if v is KeyError:
            p.pop(k)
        else:
            p[k] = v
    return p


def run(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n long, raw string")
    out = reshape_profiles(df, "raw", ["n"]).collect()
    return out


def test_cases(spark):
    loc_no_street = dict(person()["location"])
    loc_no_street.pop("street")
    loc_null_city = dict(person()["location"], city=None)
    texts = [
        json.dumps({"results": [person()]}),
        json.dumps({"results": [person(location=dict(person()["location"], postcode="AB1"))]}),
        json.dumps({"results": [person(), person(email="second@x")]}),
        json.dumps({"results": []}),
        json.dumps({"results": [person(location=loc_no_street)]}),
        json.dumps({"results": [person(location=loc_null_city)]}),
        json.dumps({"results": [person(gender=None)]}),
        json.dumps({"results": [person(gender=KeyError)]}),
        '{"results": [{"gender": "a", "gender": "b"}]}',
        "{oops",
        "",
    ]
    rows = run(spark, texts)
    assert rows[0]["reject_reason"] is None
    assert rows[0]["post_code"] == "63104"
    assert rows[0]["address"] == "8929 Valwood Pkwy, C, S, US"
    assert rows[1]["post_code"] == "AB1"
    assert rows[2]["email"] == "ann@x"
    assert rows[3]["reject_reason"] == "no_result"
    assert rows[4]["reject_reason"] == "missing_field"
    assert rows[5]["reject_reason"] == "null_field"
    assert rows[6]["reject_reason"] is None and rows[6]["gender"] is None
    assert rows[7]["reject_reason"] == "missing_field"
    assert rows[8]["reject_reason"] == "bad_json"
    assert rows[9]["reject_reason"] == "bad_json"
    assert rows[10]["reject_reason"] == "bad_json"
    assert len({r["id"] for r in rows}) == len(rows)
