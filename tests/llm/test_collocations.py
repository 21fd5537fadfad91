"""Phrase counting in quotient filters against counters."""

import re
import string
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd import empty, odd, odd_rows, prose  # noqa: F401  fixtures

from tidewater.llm import collocations as C

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, least=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {q for p, a in found.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * c[q]}
        rank = []
        for p in found.keys() - inside:
            score, k = min((1000000 * found[p] ** 2 // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rank.append((-score, -found[p], " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rank)[:top])]
    return sorted(out)


@pytest.mark.parametrize("size,words", [(1, 2), (5, 3), (2 ** 21 - 1, 3), (2 ** 28, 3), (2 ** 40, 3), (2 ** 30, 4)])
def test_the_permutation_is_undone(size, words):
    p = C.Packing(size, words)
    rng = np.random.default_rng(size % 1000)
    columns = [rng.integers(0, min(size, 2 ** 62) + 1, 5000) for _ in range(words)]
    high, low = p.permute(*p.pack(columns))
    assert max(int(high.max()), int(low.max())) <= int(p.mask)
    for got, want in zip(p.unpack(*p.invert(high, low)), columns):
        assert (got == want).all()


def test_too_many_bits_are_refused():
    with pytest.raises(ValueError):
        C.Packing(2 ** 50, 3)


@pytest.mark.parametrize("half", [4, 27, 32, 33, 60, 63])
@pytest.mark.parametrize("shards", [1, 7])
def test_filters_keep_every_count(half, shards):
    rng = np.random.default_rng(half)
    want, filters = Counter(), defaultdict(list)
    for size in (1, 3, 4000):
        high, low = (rng.integers(0, 1 << half, size, dtype=np.uint64) & np.uint64(rng.integers(0, 1 << half) | 1) for _ in "ab")
        n = rng.choice([1, 2, 254, 255, 256, 10 ** 12], size)
        for h, x, c in zip(high.tolist(), low.tolist(), n.tolist()):
            want[h, x] += c
        for k, f in C.QuotientFilter.counted(high, low, n, half).cut(shards, half):
            filters[k].append(C.QuotientFilter.decode(f.encode(half), half))
    got, last = Counter(), (-1, -1)
    for k in sorted(filters):
        m = C.QuotientFilter.merged(filters[k], half)
        for h, x, c in zip(m.high.tolist(), m.low.tolist(), m.count.tolist()):
            assert (h, x) > last  # sorted, no entry twice, shards in order
            last, got[h, x] = (h, x), c
    assert got == want


def test_a_filter_is_compact():
    rng = np.random.default_rng(1)
    high, low = (rng.integers(0, 1 << 27, 100_000, dtype=np.uint64) for _ in "ab")
    f = C.QuotientFilter.counted(high, low, np.ones(100_000, np.int64), 27)
    assert len(f.encode(27)) < 8 * len(f.high)  # 54 bits of the phrase and its counter


def test_phrases_of_odd_rows(spark, odd, odd_rows, monkeypatch):
    rows = [(r[1], r[2]) for r in odd_rows] + [(odd_rows[11][1], None)] * 2
    more = odd.select("text", "lang", "kept").unionByName(
        spark.createDataFrame([(t, x, "own") for t, x in rows[len(odd_rows):]], "text string, lang string, kept string"))
    texts = ["New York, new york! NEW\tYORK new york\nnew york. " * 4, "a b c " * 30, "x.y;z " * 20, "of the " * 40 + "of\x0bthe", "é É " * 12, "\ta  b\t"]
    more = more.unionByName(spark.createDataFrame([(t, "en", "own") for t in texts], more.schema))
    rows += [(t, "en") for t in texts]
    assert sorted(map(tuple, C.collocations(more).collect())) == brute(rows)
    assert sorted(map(tuple, C.collocations(more, least=3, top=5).collect())) == brute(rows, 3, 5)


def test_small_blocks_and_many_shards(spark, odd, odd_rows):
    """The same counts when texts, tasks and filters are cut small."""
    rows = [(r[1], r[2]) for r in odd_rows]
    old = C.TEXT_BYTES, C.SHARD_WORDS, C.TASK_PHRASES
    C.TEXT_BYTES, C.SHARD_WORDS, C.TASK_PHRASES = 1000, 3000, 500
    try:
        got = sorted(map(tuple, C.collocations(odd, least=4).collect()))
    finally:
        C.TEXT_BYTES, C.SHARD_WORDS, C.TASK_PHRASES = old
    assert got == brute(rows, 4)


def test_empty_table_and_nothing_frequent(spark, empty):
    assert C.collocations(empty).count() == 0
    one = spark.createDataFrame([("a b c", "en"), (None, None), ("", "")], "text string, lang string")
    assert C.collocations(one).count() == 0


def test_scores_pass_64_bits(spark):
    df = spark.createDataFrame([(3 * 10 ** 9, 4 * 10 ** 9, 10 ** 10)], "a long, l long, r long")
    assert df.select(C._score("a", "l", "r")).first()[0] == 10 ** 6 * 9 * 10 ** 18 // (4 * 10 ** 19)
