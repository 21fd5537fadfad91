"""A group of near copies is gathered by leaders; few of its pairs are left."""

import random

import numpy as np
from pyspark.sql import functions as F

from tidewater.llm import ngram_join as N

MEMBERS = 160


def near_copies():
    r = random.Random(11)
    base = [f"w{r.randrange(10**6)}" for _ in range(300)]
    out = []
    for _ in range(MEMBERS):
        words = list(base)
        for _ in range(r.randrange(2, 5)):
            words[r.randrange(len(words))] = f"x{r.randrange(10**9)}"
        out.append(" ".join(words))
    return out


def brute(texts):
    sets = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    top = list(range(len(texts)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if 100 * same >= 80 * (len(sets[i]) + len(sets[j]) - same):
                a, b = sorted((root(i), root(j)))
                top[b] = a
    return [root(i) for i in range(len(texts))]


def test_few_pairs_of_near_copies_are_compared(spark, monkeypatch):
    texts, sizes, saved = near_copies(), {}, N.saved

    def counted(df, name):
        out = saved(df, name)
        sizes.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(N, "saved", counted)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted((x["doc_id"], x["component_id"]) for x in N.ngram_groups(docs).collect())
    assert got == list(enumerate(brute(texts)))
    assert sizes["ngram-star"][0] > 0.9 * MEMBERS / 2
    assert sizes["ngram-pairs"][0] < MEMBERS * MEMBERS / 8


def test_order_by_text_is_that_of_both_keys():
    r = np.random.RandomState(2)
    for texts in (1, 7, 70_000):
        d = np.sort(r.randint(0, texts, 5000))
        h = r.randint(0, 1 << 62, 5000, dtype=np.uint64)
        h[1:4000:2] = h[:4000:2]
        order = N.by_text(h, d, texts)
        want = np.lexsort((h, d))
        assert (h[order] == h[want]).all() and (d[order] == d[want]).all()


def joined(spark, monkeypatch, texts):
    """Rows of the last join of different components, after the result is checked."""
    kept, saved = {}, N.saved

    def noted(df, name):
        kept[name] = saved(df, name)
        return kept[name]

    monkeypatch.setattr(N, "saved", noted)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted((x["doc_id"], x["component_id"]) for x in N.ngram_groups(docs).collect())
    assert got == list(enumerate(brute(texts)))
    return kept


def test_classes_that_share_a_line_only_seldom_meet(spark, monkeypatch):
    r = random.Random(3)
    line = " ".join(f"w{k}" for k in range(20))
    texts = [" ".join([*[f"x{r.randrange(10**9)}" for _ in range(40)], line]) for _ in range(30)]
    kept = joined(spark, monkeypatch, texts)
    x, y = kept["ngram-left"].alias("x"), kept["ngram-left"].alias("y")
    met = x.join(y, F.expr("x.token = y.token and x.cls < y.cls"))
    early = met.where(N._early(F.col("x.n"), F.col("x.at"), F.col("y.n"), F.col("y.at"))[0])
    assert met.count() > 30 * 29 / 2 and early.count() < met.count() / 1.5


def test_rows_of_far_near_copies_are_gathered(spark, monkeypatch):
    r = random.Random(12)
    base = [f"w{r.randrange(10**6)}" for _ in range(200)]
    texts = []
    for _ in range(150):
        words = list(base)
        for _ in range(r.randrange(1, 9)):
            words[r.randrange(len(words))] = f"x{r.randrange(10**9)}"
        texts.append(" ".join(words))
    kept = joined(spark, monkeypatch, texts)
    assert kept["ngram-pairs"].count() < 150 * 149 / 2 / 8


def test_early_shingles_keep_every_link():
    """Linking sets share `few` of the places that the join reads, at all sizes."""
    for na in range(1, 70):
        for nb in range(na, 70):
            if 100 * na < N.PERCENT * nb:
                continue
            need = -(-N.PERCENT * (na + nb) // (100 + N.PERCENT))
            most = min(need - (-(-N.PERCENT * n // 100) - 1) for n in (na, nb))
            few = min(max(most, 1), N.FEW)
            for n in (na, nb):
                assert n - need + few <= n - -(-N.PERCENT * n // 100) + 1
