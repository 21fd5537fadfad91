"""What a worker of the packing operator keeps and takes is bounded."""

import random
import tracemalloc

import pyarrow as pa
import public_tokenizers as P

from tidewater.llm import common, packing

WORDS = P.path("word_bpe_49k.json")


def texts(n, words, seed=3):
    r = random.Random(seed)
    draw = lambda: "".join(r.choice("aeinrstÄß") for _ in range(r.randrange(1, 9))) + r.choice(["", "", ".", ",", "7"])
    return [" ".join(draw() for _ in range(words)) for _ in range(n)]


def test_curve_keys_take_little_memory(monkeypatch):
    column = pa.array(texts(1500, 400))
    assert column.nbytes > 2 << 20
    monkeypatch.setattr(common.Rolling, "_powers", {})
    tracemalloc.start()
    packing.curve_keys(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20


def test_curve_keys_do_not_depend_on_the_pieces(monkeypatch):
    column = pa.array(["x" * 300_000, None, "", *texts(300, 300), "a b " * 100_000])
    whole = packing.curve_keys(column)
    monkeypatch.setattr(packing, "KEY_BYTES", 1 << 12)
    assert (packing.curve_keys(column) == whole).all()


def test_a_full_cache_changes_no_ids(monkeypatch):
    assert packing.CACHED_WORDS <= 400_000
    monkeypatch.setattr(packing, "CACHED_WORDS", 50)
    encoder = packing.Encoder(WORDS)
    long = "y" * (packing.CACHED_WORD_CHARS + 5)
    batches = [["", long + ".", "a a. a, A"], texts(20, 30), [long, "a a."], texts(20, 30, 4), texts(20, 30)]
    for batch in batches:
        for text, ids in zip(batch, encoder.encode_all(batch)):
            want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
            assert list(memoryview(ids).cast("I")) == want
        assert len(encoder.words) <= 50
        assert max(map(len, encoder.words)) <= packing.CACHED_WORD_CHARS


def test_blanks_of_all_kinds():
    encoder = packing.Encoder(WORDS)
    blanks = [c for c in map(chr, range(0x3001)) if c.isspace()] + ["​", "﻿"]
    batch = [f"{c}Ab{c}{c} c.{c}d7 {c} e{c}" for c in blanks] + ["".join(blanks), None, "", " \n ", "é ́x"]
    got = encoder.encode_all(pa.array(["sliced", *batch]).slice(1))
    for text, ids in zip(batch, got, strict=True):
        assert list(memoryview(ids).cast("I")) == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
