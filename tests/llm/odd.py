"""Odd rows for the tests of this folder, as fixtures to import."""

import random

import pytest


def prose(seed, n, words="the of and to river stone cloud winter maple harbour lantern copper violet engine signal".split()):
    r = random.Random(seed)
    return " ".join(r.choice(words) + (str(r.randrange(40)) if r.random() < 0.6 else "") for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source, n_chars): nulls, empty and blank texts, copies, near
    copies, a shared passage, a long text, repeated rows."""
    base, passage = prose(1, 120), prose(2, 60)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, " ".join(near), "en", None, None),
        (4, None, None, None, None), (5, "", "de", "b", 0), (6, " \n\t ", "fr", "b", 4),
        (7, "one two", "xx", "b", 7), (8, "One  TWO", "en", "c", 8),
        (9, prose(3, 90) + " " + passage + " " + prose(4, 30), "en", "c", 5),
        (10, passage, "en", "c", 5), (11, prose(5, 40) + "\n" + passage, "en", "c", 5),
        (12, prose(6, 30000), "en", "d", 9), (13, "x " * 300, "en", "d", 9), (14, "ÀÉ 日本 \U0001F600 " * 40, "es", "d", 9),
        (14, "ÀÉ 日本 \U0001F600 " * 40, "es", "d", 9), (None, prose(7, 80), "en", "e", 2), (None, base, "en", "e", 2),
        (15, "you idiot " * 20, "en", "e", 2), (16, "Released under the MIT License. All rights reserved.", "en", "e", 2),
    ]
    return rows


@pytest.fixture()
def odd(spark, odd_rows):
    """The rows as a table with extra columns named like outputs."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    from pyspark.sql import functions as F
    return spark.createDataFrame(odd_rows, schema).withColumns(
        {c: F.lit("own") for c in ("shard", "kept", "score", "ids", "cls", "txt", "seq", "key", "license")})


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
