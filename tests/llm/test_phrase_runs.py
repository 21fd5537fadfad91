"""Passages are read once for each text, and phrases in a row are located as one."""

import random

import brute
import pyarrow as pa

from tidewater.llm import phrase_dedup as P


def copied(r):
    """Documents that share long stretches, some from two sources that overlap."""
    line = [f"w{r.randrange(50)}" for _ in range(400)]
    rows = []
    for i in range(60):
        a = r.randrange(330)
        own = [f"x{i}y{k}" for k in range(r.randrange(4))]
        rows.append((r.choice([i, i, i, None, i // 2]), " ".join(own + line[a:a + r.randrange(10, 60)] + own)))
    return rows + [rows[3], (500, rows[4][1]), (-1, rows[5][1])]


def test_runs_equal_windows(spark):
    for s in range(2):
        rows = copied(random.Random(s))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        key = lambda x: tuple((v is None, v) for v in x)
        assert (sorted(map(tuple, P.dedup_rows(docs).collect()), key=key)
                == sorted(map(tuple, brute.phrase_rows(rows)), key=key))


def test_each_text_is_streamed_once(spark, monkeypatch):
    line = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(i, f"a{i} {line} z{i}") for i in range(40)], "doc_id long, text string")
    sizes, saved = {}, P.saved

    def counted(df, name):
        out = saved(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(P, "saved", counted)
    assert [r["n_removed"] for r in P.dedup_rows(docs).orderBy("doc_id").collect()] == [0] + [60] * 39
    assert sizes["phrase-texts"] < sizes["phrase-passages"] / 2
    assert sizes["phrase-located"] <= sizes["phrase-texts"]


def test_phrases_in_a_row_are_one_run():
    words = [f"w{k}" for k in range(P.WINDOW + 4)]
    keys = P.window_keys(" ".join(words).encode())
    firsts = [1, 1, None, 2, 2]
    known = [(k, f) for k, f in zip(keys, firsts) if f is not None]
    passages = pa.table({"seed": [7], "passage": [" ".join(words)], "seq": [9], "at": [100], "doc_id": [5]})
    phrases = pa.table({"seed": [7] * 4, "phrase": [k for k, _ in known], "first": [f for _, f in known]})
    got = P.locate(passages, phrases).to_pylist()
    assert [tuple(x.values()) for x in got] == [(7, 9, 100, 102, 1), (7, 9, 103, 105, 2)]
