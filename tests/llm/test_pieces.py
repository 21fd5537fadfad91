import random

import public_tokenizers as P
import pyarrow as pa
import pytest

from tidewater.llm import pieces

MODEL = P.path("piece_bpe_32k.model")


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_new_words_share_their_beginnings(monkeypatch, kind):
    """A group's new words are searched from where they part from the word before,
    with the ids that a search of each alone gives."""
    rng = random.Random(5)
    heads = ["".join(rng.choice("abcdefgéñ的\U0001f600") for _ in range(9)) for _ in range(12)]
    words = [rng.choice(heads) + "".join(rng.choice("ab.,!\n") for _ in range(3)) for _ in range(400)]
    words += ["x" * 70, "", "▁", "  ", "\x00", *heads]
    texts = [" ".join(rng.sample(words, 40)) for _ in range(20)] + ["", " ", "a  b ", "▁x▁"]
    v = pieces.Vocabulary(MODEL, kind)
    searched = []
    extend = pieces.Stream._extend
    monkeypatch.setattr(pieces.Stream, "_extend", lambda s, c: (searched.append(len(c)), extend(s, c))[1])
    alone = [pieces.Encoder(v)._search(pieces.MARK + t.replace(" ", pieces.MARK)) if t else b"" for t in texts]
    searched.clear()
    encoder = pieces.Encoder(v)
    assert encoder.encode_all(texts) == alone
    new = {w for t in texts for w in encoder._cut.findall(pieces.MARK + t.replace(" ", pieces.MARK))}
    assert 0 < sum(searched) < sum(map(len, new)) / 2
    searched.clear()
    assert encoder.encode_all([t for t in texts if "x" * 70 not in t]) == [c for c, t in zip(alone, texts) if "x" * 70 not in t]
    assert not searched  # all of them are known now


def test_groups_hold_every_row(monkeypatch):
    monkeypatch.setattr(pieces, "GROUP_BYTES", 10)
    for texts in (["a" * 30, None, "", "bbbb", "cccccc", "d", "e" * 11, None], [None], ["x"], ["", ""]):
        batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
        assert [t for g in pieces._groups(batch, "text") for t in g.column("text").to_pylist()] == texts
        assert [t for g in pieces._groups(batch.slice(1), "text") for t in g.column("text").to_pylist()] == texts[1:]
