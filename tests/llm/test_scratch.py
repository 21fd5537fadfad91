"""Written intermediates and shuffle files go once no later step reads them."""

import glob
import os
import random
import re
import time

from pyspark.sql import functions as F

from tidewater.llm import components as C
from tidewater.llm import ngram_join as N
from tidewater.llm import quality
from tidewater.llm.common import dropped, hash_bitmap, saved


def near_texts(r, n=40):
    base = [f"w{r.randrange(10**6)}" for _ in range(120)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(r.randrange(1, 6)):
            words[r.randrange(len(words))] = f"x{r.randrange(10**9)}"
        out.append(" ".join(words))
    return out


def watch(monkeypatch, module):
    """(name, table, folder, columns) of all that the module writes."""
    made, real = [], module.saved

    def noted(df, name):
        out = real(df, name)
        made.append((name, out.inputFiles(), df.columns))
        return out

    monkeypatch.setattr(module, "saved", noted)
    return made


def left_of(made):
    return {name for name, files, _ in made if any(os.path.exists(f.removeprefix("file://")) for f in files)}


def test_dropped_removes_that_table_only(spark):
    a, b = saved(spark.range(5), "test-a"), saved(spark.range(6), "test-b")
    files = a.inputFiles()
    dropped(a)
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
    assert b.count() == 6


def test_near_duplicates_leave_no_postings_and_sets(spark, monkeypatch):
    texts = near_texts(random.Random(21)) + ["a b c d e f", "a b c d e f", "", None]
    docs = spark.createDataFrame([(i if i != 1 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = {r["doc_id"]: r["component_id"] for r in N.ngram_groups(docs).collect()}
    made, rounds = watch(monkeypatch, N), watch(monkeypatch, C)
    out = N.keep_one(docs)
    left = left_of(made)
    assert {"ngram-survey", "ngram-postings", "ngram-sets"} <= {name for name, _, _ in made}
    assert not left & {"ngram-survey", "ngram-postings", "ngram-leaders", "ngram-sets", "ngram-placed", "ngram-mixed"}
    assert left_of(rounds) == {"cc-edges"}
    got = [r["doc_id"] for r in out.collect()]  # reads nothing that is gone
    key = lambda x: (x is None, x or 0)
    assert sorted(got, key=key) == sorted((d for d, c in want.items() if d == c), key=key)


def test_near_duplicates_shuffle_texts_once(spark):
    r = random.Random(22)
    rows = [(i, t) for i, t in enumerate(near_texts(r, 12))]
    rows += [(None, "one two three four five six"), (None, "one two three four five six"), (3, rows[3][1]), (50, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = N.keep_one(docs)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2  # texts, and the kept rows' keys
        got = out.collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted((x["doc_id"] is None, x["doc_id"] or 0) for x in got) == sorted(
        (d is None, d or 0) for d in [r["component_id"] for r in N.ngram_groups(docs).where(
            "n_shingles > 0").select("component_id").distinct().collect()] + [50])


def test_quality_filter_writes_no_texts(spark, monkeypatch):
    r = random.Random(23)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    rows = [(i, " ".join(word() for _ in range(80)), r.choice(["en", "de", None]), "s") for i in range(30)]
    rows += [(30, "too short", "en", "s"), (31, None, "fr", "s"), (None, "###### " * 400, "en", None), (5, "1 2 3 " * 300, "xx", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    made = watch(monkeypatch, quality)
    got = quality.keep_good(docs)
    assert got.columns == docs.columns
    assert [(name, c) for name, _, c in made] == [
        ("quality-references", ["ref_lang", "ref_words", "ref_chars", "ref_common"])]
    want = quality.quality_rows(docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(99)) * 10 + F.length(
        F.coalesce("text", F.lit(""))) % 10)).where("kept")
    # the query form judges the same rows
    assert got.count() == want.count() > 20
    assert {x["doc_id"] for x in got.collect()} == {x["doc_id"] // 10 if x["doc_id"] // 10 != 99 else None
                                                    for x in want.collect()}


def test_bitmaps_give_their_shuffle_files_back(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    folders = env.blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before = files()
    rows = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    bitmap = hash_bitmap(rows, "h")
    assert bitmap.value.words.any()
    for _ in range(20):
        if not files() - before:
            break
        time.sleep(0.5)
    assert not files() - before
