"""Each operator on odd rows and on an empty table, against brute force."""

import random

import numpy as np
import pytest
import public_tokenizers as P

import brute
from odd import empty, odd, odd_rows  # noqa: F401  fixtures
from tidewater.llm import (embeddings, licenses, ngram_join, packing, phrase_dedup, pieces, quality, sharding,
                           suffix_dedup, toxicity)

MODEL, WORDS = P.path("piece_bpe_32k.model"), P.path("word_bpe_49k.json")
some = lambda t: tuple((x is None, x) for x in t)  # noqa: E731  sorts nulls


def rows(df):
    return sorted(map(tuple, df.collect()), key=some)


def plain(odd_rows):
    return [(r[0], r[1]) for r in odd_rows]


def test_pieces_equal_the_library(spark, odd, odd_rows, empty):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = pieces.encode_documents(odd.select("doc_id", "text", "ids"), MODEL)
    got = sorted(((r.doc_id, list(r.ids)) for r in out.collect()), key=some)
    assert got == sorted(((i, sp.encode(t or "")) for i, t in plain(odd_rows)), key=some)
    assert all(r.round_trip for r in out.collect())
    back = pieces.decode_documents(out, MODEL)
    assert sorted(r.text for r in back.collect()) == sorted(t or "" for _, t in plain(odd_rows))
    assert pieces.encode_documents(empty, MODEL).count() == 0


def test_stream_keeps_a_window_only(odd_rows):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    enc = pieces.Encoder(pieces.Vocabulary(MODEL))
    text = odd_rows[0][1] + "a" * 500 + " " * 70 + "▁z"
    assert list(enc.stream(text[k:k + 7] for k in range(0, len(text), 7))) == sp.encode(text)
    s = pieces.Stream(enc.v)
    most = 0
    for c in ("▁" + odd_rows[11][1].replace(" ", "▁"))[:5000]:
        s.feed(c)
        most = max(most, len(s.text))
    assert most <= 4 * enc.v.longest


def test_unigram_edges_are_the_best_path():
    v = pieces.Vocabulary(MODEL, "unigram")
    for word in ("▁hello", "▁unbelievable", "▁the", "thethe"):
        best = [0.0] + [-1e18] * len(word)
        for i in range(1, len(word) + 1):
            for j in range(max(0, i - v.longest), i):
                s = v.scores.get(word[j:i], v.worst if i - j == 1 else None)
                if s is not None:
                    best[i] = max(best[i], best[j] + s)
        s = pieces.Stream(v)
        got = s.feed(word) + s.finish()
        assert sum(v.scores.get(p, v.worst) for p in got) == pytest.approx(best[-1])


def test_shards(odd, odd_rows, empty):
    got = sharding.shard_documents(odd).collect()
    for r in got:
        assert (r.shard, r.grown_shard) == (brute.shard_of(r.doc_id, 8), brute.shard_of(r.doc_id, 9))
        assert r.grown_shard in (r.shard, 8)
    assert sorted((r.size, r.text_crc32) for r in got) == sorted(
        (len((t or "").encode()) + 1, brute.crc(t)) for _, t in plain(odd_rows))
    for s in range(8):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard_documents(empty).count() == 0


def test_weights(spark):
    from pyspark.sql import functions as F
    df = sharding.assign(spark.range(6000).withColumnRenamed("id", "k"), "k", [1.0, 2.0, 3.0])
    n = {r.shard: r["count"] for r in df.groupBy("shard").count().collect()}
    assert [round(n[s] / 1000) for s in range(3)] == [1, 2, 3]
    moved = df.withColumn("w", sharding.rendezvous(F.col("k"), [1.0, 2.0, 4.0])).where("w <> shard")
    assert moved.where("w <> 2").count() == 0


def test_embeddings(spark):
    rng = np.random.RandomState(3)
    base = rng.standard_normal((60, 16))
    vecs = [[float(x) for x in v] for b in base for v in (b, b + rng.standard_normal(16) * 0.1, b)]
    data = [(i, v, i % 3 if i % 10 else None) for i, v in enumerate(vecs)]
    data += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] * 16, 1), (904, [], 1),
             (905, [1.0, 2.0], 1), (906, [2.0, 4.0], 1), (907, vecs[1], 1), (907, vecs[1], 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")

    def ok(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = []
    for i, (_, v, l) in enumerate(data):
        for j in range(i):
            _, w, m = data[j]
            if l is not None and l == m and ok(v) and ok(w) and len(v) == len(w):
                if np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93:
                    links.append((i, j))
    n = [sum(i in p for p in links) for i in range(len(data))]
    g = brute.smallest(range(len(data)), links)
    want = sorted((data[i][0], n[i], min(data[j][0] for j in g if g[j] == g[i])) for i in g)
    got = rows(embeddings.embedding_groups(df))
    found = sum(r[1] for r in got)
    assert 0.9 * sum(n) <= found <= sum(n)  # an index; all links here in practice
    assert [r[:3] for r in got] == want and all(r[3] == (r[0] == r[2]) for r in got)
    assert embeddings.embedding_groups(df.where("false")).count() == 0


def test_ngram_join(odd, odd_rows, empty):
    assert rows(ngram_join.ngram_groups(odd)) == sorted(brute.ngram_rows(plain(odd_rows)), key=some)
    assert ngram_join.ngram_groups(empty).count() == 0
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    want = {i for i, n, c in brute.ngram_rows(plain(odd_rows)) if i == c or not n}
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x)) == sorted(
        want, key=lambda x: (x is None, x))


def test_suffix_dedup(odd, odd_rows, empty):
    assert rows(suffix_dedup.dedup_rows(odd)) == sorted(brute.suffix_rows(plain(odd_rows)), key=some)
    assert suffix_dedup.dedup_rows(empty).count() == 0
    cut = suffix_dedup.remove_repeats(odd)
    assert cut.columns == odd.columns and cut.count() == odd.count()


def test_phrase_dedup(odd, odd_rows, empty):
    assert rows(phrase_dedup.dedup_rows(odd)) == sorted(brute.phrase_rows(plain(odd_rows)), key=some)
    assert phrase_dedup.dedup_rows(empty).count() == 0


def test_packing(odd, odd_rows, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORDS)
    got = packing.pack(odd, WORDS, with_ids=True).collect()
    by_seq, by_doc = {}, {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at and r.length == len(r.ids)
            at += r.length
        assert at == 4096 or at & (at - 1) == 0
    want = sorted(tok.encode(t or "", add_special_tokens=False).ids + [2] for _, t in plain(odd_rows))
    assert sorted(x for r in got for x in r.ids) == sorted(x for w in want for x in w)
    one = [i for r in sorted(by_doc[12, len(tok.encode(odd_rows[11][1]).ids) + 1], key=lambda r: r.start) for i in r.ids]
    assert one == tok.encode(odd_rows[11][1], add_special_tokens=False).ids + [2]
    assert packing.pack(empty, WORDS).count() == 0


def test_hilbert_steps_to_neighbours():
    at = np.array([(i, j, k) for i in range(8) for j in range(8) for k in range(8)])
    key = packing.hilbert(at, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(at[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_quality(odd, odd_rows, empty):
    got = quality.quality_rows(odd).collect()
    assert len(got) == len(odd_rows)
    by = {(r.doc_id, r.n_words): r for r in got}
    assert by[13, 300].n_repeat_words == 300 and by[13, 300].base_failed and not by[13, 300].kept
    assert by[4, 0].base_failed and by[1, 120].kept
    assert quality.quality_rows(empty).count() == 0
    assert quality.keep_good(odd).columns == odd.columns


def test_licenses(odd, empty):
    got = {r.doc_id: r for r in licenses.license_rows(odd).collect()}
    assert (got[16].license, got[16].licenses, got[16].n_sentences) == ("MIT", "MIT", 2)  # "all rights reserved" counts alone only
    assert got[4].license is None and got[4].licenses == "" and got[1].n_sentences == 0
    assert licenses.license_rows(empty).count() == 0


def test_toxicity_without_labels(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity_rows(odd, labels).collect()} == {0.0}
    assert toxicity.toxicity_rows(empty, labels).count() == 0


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = toxicity.toxicity_rows(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_capital_rate_is_per_letter_at_every_length():
    at = toxicity.FEATURES.index("capital_rate")
    line = "Mixed Case and SHOUT 123 don't ÀÉ ǅ日A ªx ß4U, "
    for text in ("", "12 34", line, line * 40, line * 41, line * 400, "plain words " * 500, "Title " * 500, "日本 " * 900):
        letters = sum(map(str.isalpha, text))
        want = sum(map(str.isupper, text)) / max(letters, 1)
        assert toxicity.features(text, frozenset())[at] == want


def test_repeated_ids_do_not_fill_the_sample(spark):
    data = [(1, "same text")] * 300 + [(1, f"text {i}") for i in range(50)] + [(2, "two"), (2, "two"), (3, None), (3, ""), (4, "no label")]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    picked = spark.createDataFrame([(1, 1, 1), (2, 0, 2), (3, 0, 4)], "doc_id long, toxic int, fold int")
    got = [tuple(r) for r in toxicity.training_rows(docs, picked).collect()]
    assert len(got) == len(set(got)) == toxicity.ROWS_PER_ID + 2
    assert {r for r in got if r[0] > 1} == {(2, "two", 0, 2), (3, "", 0, 4)}
    assert {r[2:] for r in got if r[0] == 1} == {(1, 1)}


def thue_morse(n, flip):
    return [(bin(i).count("1") + flip) % 2 for i in range(n)]


@pytest.fixture(scope="module")
def flags():
    """Two documents that differ in every n-th word or byte by the pattern that a
    polynomial modulo 2**64 cannot see."""
    import random
    r = random.Random(9)
    filler = [f"w{r.randrange(10 ** 9)}" for _ in range(2048 * 12)]
    plain = [r.randbytes(99).hex() for _ in range(2048)]

    def by_words(n):
        return [" ".join(w for i, f in enumerate(thue_morse(2048, x)) for w in [("yes", "no")[f], *filler[i * (n - 1):(i + 1) * (n - 1)]])
                for x in (0, 1)]
    return {"5": by_words(5), "13": by_words(13),
            "199": ["".join("yn"[f] + t for f, t in zip(thue_morse(2048, x), plain)) for x in (0, 1)],
            "word": ["a b c d " + "".join("yn"[f] for f in thue_morse(4096, x)) + " e f g h i j k l m" for x in (0, 1)]}


def pair(spark, texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")


def test_different_word_sequences_are_not_merged(spark, flags):
    got = rows(ngram_join.ngram_groups(pair(spark, flags["5"])).select("doc_id", "n_shingles", "component_id"))
    assert got == brute.ngram_rows(list(enumerate(flags["5"], 1))) and [r[2] for r in got] == [1, 2]


@pytest.mark.parametrize("which", ["13", "word"])
def test_different_word_sequences_keep_their_words(spark, flags, which):
    got = rows(phrase_dedup.dedup_rows(pair(spark, flags[which])))
    assert got == brute.phrase_rows(list(enumerate(flags[which], 1))) and [r[2] for r in got] == [0, 0]


def test_different_texts_keep_their_bytes(spark, flags):
    got = rows(suffix_dedup.dedup_rows(pair(spark, flags["199"])))
    assert [r[:4] for r in got] == [(i, 199 * 2048, 0, 0) for i in (1, 2)]


def test_long_words_are_told_apart(flags):
    import pyarrow as pa
    from tidewater.llm.common import text_batches
    (_, _, b), = text_batches(pa.array([t.split()[4] for t in flags["word"]]))
    start, end, _ = b.words()
    assert len(set(b.word_hashes(start, end).tolist())) == 2


def test_words_by_letters_equal_the_tokenizer():
    r = random.Random(3)
    letters = "abcdefgABCDEFGéÉßÿÀñstlmvre'"
    words = ["".join(r.choice(letters) for _ in range(r.randrange(1, 12))) + r.choice(["", "", *packing.ENDS, ".,", "7", "\u0301", "\u4e2d"])
             for _ in range(4000)]
    texts = [" ".join(words[i:i + 9]) for i in range(0, len(words), 9)] + ["", "a\u3000b. c\u00a0d,", "\ufb01x. \u0130a \u212a!"]
    encoder = packing.Encoder(WORDS)
    assert encoder.letters
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):  # the second time from the kept words
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode_all(texts)] == want
