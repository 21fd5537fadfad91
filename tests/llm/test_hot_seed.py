"""A seed with far more phrases than a shard holds is split."""

import random

from pyspark.sql import functions as F

from tidewater.llm import phrase_dedup as P


def tables(spark):
    """Passages of one hot seed and of a few small ones, each in two documents."""
    r = random.Random(5)
    rows, phrases = [], {}
    for k in range(300):
        seed = 7 if k < 270 else 100 + k
        words = [f"w{r.randrange(9)}x{k}" for _ in range(8)] + "a common line of words".split() + [f"w{r.randrange(9)}y{k}" for _ in range(8)]
        words = words[: r.randrange(P.WINDOW, len(words) + 1)]
        for doc in (2 * k, 2 * k + 1):
            rows.append((seed, " ".join(words), doc + 10_000, k, doc))
        for i in range(len(words) - P.WINDOW + 1):
            phrases[seed, P.window_key(" ".join(words[i:i + P.WINDOW]).encode())] = 2 * k
    want = sorted((doc + 10_000, at + i) for _, text, _, at, doc in rows if doc % 2
                  for i in range(len(text.split()) - P.WINDOW + 1))
    return (spark.createDataFrame(rows, "seed long, passage string, seq long, at int, doc_id long"),
            spark.createDataFrame([(*k, v) for k, v in phrases.items()], "seed long, phrase long, first long"), want)


def test_hot_seed_is_split(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD_PHRASES", 50)
    monkeypatch.setattr(P, "TASK_PASSAGES", 100)
    passages, phrases, want = tables(spark)
    got = P._occurrences(passages, phrases).distinct()
    assert sorted(map(tuple, got.collect())) == want
    spread, copies = P._dealt(passages, phrases)
    most = lambda df: df.groupBy("shard", "part").count().agg(F.max("count")).first()[0]
    assert phrases.where("seed = 7").count() > 20 * P.SHARD_PHRASES
    assert most(copies) <= 3 * P.SHARD_PHRASES
    assert most(spread) <= 3 * P.TASK_PASSAGES
    assert copies.count() <= 3 * phrases.count()


def test_small_seeds_keep_whole_passages(spark):
    passages, phrases, want = tables(spark)
    assert sorted(map(tuple, P._occurrences(passages, phrases).distinct().collect())) == want
    assert P._dealt(passages, phrases)[0].count() == passages.count()


def test_window_keys_are_the_same_in_columns(spark):
    texts = [" ".join(f"wé{i * k}" for i in range(P.WINDOW + k)) for k in range(4)]
    rows = [(text, k, " ".join(text.split(" ")[k:k + P.WINDOW])) for text in texts
            for k in range(len(text.split(" ")) - P.WINDOW + 1)]
    got = spark.createDataFrame(rows, "text string, k int, window string").select("text", "k", P._key_of(F.col("window")))
    assert all(P.window_keys(text.encode())[k] == key for text, k, key in got.collect())
