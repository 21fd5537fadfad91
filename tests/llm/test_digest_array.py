"""Sorted digest arrays and the URL filter on them, against plain Python."""

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidewater.llm import digest_array, url_filter


def hashes(terms):
    return np.array([xxhash.xxh64_intdigest(t.encode(), 42) for t in terms], np.uint64)


@pytest.mark.parametrize("shard_terms", [1 << 20, 100])
def test_terms_are_found_over_shards(spark, shard_terms):
    terms = [f"w{i}é" for i in range(1000)] + ["", " "]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(terms)] + [(None, 7), ("w3é", 0)], "term string, n long")
    array = digest_array.build(df, "term", "n", "test", shard_terms)
    assert array.size == len(terms) and (len(array.shards) > 4) == (shard_terms == 100)
    asked = terms + ["absent", "w1", "w3"]
    found = array.find(hashes(asked), pa.array(asked))
    assert sorted(found[:len(terms)]) == list(range(len(terms))) and (found[len(terms):] == -1).all()
    assert array.terms(found[:len(terms)]).to_pylist() == terms
    assert array.payloads(found[:len(terms)]).tolist() == list(range(len(terms)))


def test_a_collision_is_told_apart(spark):
    """Equal hashes for different terms: only the stored string decides."""
    rows = pa.table({"shard": [0] * 4, "hash": np.array([9, 5, 9, 9]), "term": ["a", "b", "c", "d"], "payload": [1, 2, 3, 4]})
    from tidewater.session import scratch_path
    made = digest_array._write(scratch_path(spark, "collide"), rows).to_pylist()[0]
    array = digest_array.DigestArray(0, [digest_array.Shard(0, 4, 0, made["path"])])
    asked = pa.array(["d", "c", "x", "b", "a", "b"])
    found = array.find(np.array([9, 9, 9, 5, 9, 9], np.uint64), asked)
    assert found.tolist()[2] == -1 and found.tolist()[5] == -1
    assert array.terms(found[[0, 1, 3, 4]]).to_pylist() == ["d", "c", "b", "a"]
    assert array.payloads(found[[0, 1, 3, 4]]).tolist() == [4, 3, 2, 1]


def test_no_terms_find_nothing(spark):
    array = digest_array.build(spark.createDataFrame([], "term string, n long"), "term", "n", "test")
    assert array.find(hashes(["a"]), pa.array(["a"])).tolist() == [-1]


RULES = (*url_filter.RULES, ("block", "a.org/x"), ("allow", "org/x/yy"), ("block", "b.a.org"), ("allow", "b.a.org"),
         ("block", ""), ("allow", "DEEP.a.b.c.d.net/p"), ("block", "com:81/"))
URLS = [None, "", "no host", "://", "http://", "https://EXAMPLE.com/en/", "http://www.example.com/en/1?x#y", "http://example.com",
        "http://notexample.com/en/", "http://sub.example.com/EN/", "http://example.com/en", "x://a.net/es/://b.com/", "http://net/fr/",
        "http://b.a.org", "http://b.a.org/x/yyy", "http://a.org/x/yy", "http://org/x/y", "http://u@example.com:80/en/",
        "http://deep.a.b.c.d.net/pq", "http://com:81/", "http://x.com:81/", "http://.com/", "http://com./", "ftp://É.com/é\n/x",
        "http://a\nb.com/en/\nz", "http://" + "a." * 5000 + "com/" + "en/" * 5000, "http://example.com/en/", "http://example.com/en/"]


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest).group()
    low = lambda s: re.sub("[A-Z]", lambda m: m.group().lower(), s)
    host, path = low(raw), re.match(r"[^?#]*", rest[len(raw):]).group()
    fits = []
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        h, p = low(h), slash + p
        if rule and host and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), len(h), verdict == "block", h + p))
    best = max(fits, default=None)
    return host, path, best and best[3], ("block" if best[2] else "allow") if best else "allow"


def test_urls_equal_plain_rules(spark):
    rows = [(i, u, "own", "own") for i, u in enumerate(URLS)] + [(None, URLS[5], "own", "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, _x string")
    index = url_filter.build_rules(url_filter.rules_of(spark, RULES))
    out = url_filter.judge(pages, index)
    assert out.columns == ["page_id", "url", "_x", "host", "path", "rule", "verdict"]
    got = sorted((r.page_id if r.page_id is not None else -1, r.host, r.path, r.rule, r.verdict) for r in out.collect())
    want = sorted((i if i is not None else -1, *judged(u, RULES)) for i, u, *_ in rows)
    assert got == want


def test_urls_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = url_filter.build_rules(url_filter.rules_of(spark, []))
    assert [r.verdict for r in url_filter.judge(pages, none, default="block").collect()] == ["block"]
    assert url_filter.url_rows(pages.limit(0)).count() == 0
