"""SentencePiece encoding and decoding as a streaming Viterbi search.

The search runs over character positions.  An edge is a piece that ends at a
position and begins at an earlier one; a position keeps one surviving edge, its
backpointer.  Pieces have a largest length, so only that many positions can begin
a later piece: they are the window.  Whenever the backpointer paths of all of them
pass one common boundary, the ids up to it are final and are given out; what is
kept is bounded by the window and not by the text.

Which edge survives depends on the model file:

* unigram models: the edge with the best sum of piece scores;
* BPE models: the edge whose piece does not merge with the piece before it, that
  is, the pair is what merging by rank makes of their joined text.  There is one
  such edge at every position, and the path is the library's own BPE result.

Both give the ids of the `sentencepiece` library.  Characters without a piece
become their UTF-8 byte pieces.  If no piece of the vocabulary crosses from a
character to a word mark (checked on loading), every path passes each word start;
the words between such boundaries are searched once per worker and remembered.
New words are searched in sorted order, many at a time: what survives at a position
depends on the characters before it alone, so a word goes on from where it parts
from the word before.

Defined results: null or empty text has no ids and decodes to an empty text; a
text that holds the word mark itself decodes with a blank in its place (as the
library does) and has round_trip false; other text comes back exactly; repeated
rows get equal ids; an empty table gives an empty table; other columns pass
through.  Models that rewrite text before encoding (normalisation rules) are
refused.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from tidewater.llm.common import arrow_apply, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARK = "▁"
CACHED_WORDS = 600_000
CACHED_CHARS = 40
GROUP_BYTES = 2 << 20  # text bytes whose new words are searched together
UNKNOWN_PENALTY = 10.0
CHECK = "  a b\téﬁ"  # a text that normalisation rules would change


class Vocabulary:
    """Pieces, scores and byte ids of a SentencePiece model file."""

    def __init__(self, path: str, kind: str = "bpe"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if kind not in ("bpe", "unigram"):
            raise ValueError(kind)
        if sp.decode(sp.encode(CHECK)) != CHECK:
            raise ValueError(f"{path} normalises text")
        self.kind = kind
        self.ids, self.scores, self.bytes = {}, {}, {}
        self.raw: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                self.raw.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                self.ids[piece] = i
                self.scores[piece] = sp.get_score(i)
                self.raw.append(piece.replace(MARK, " ").encode())
        self.unknown = sp.unk_id()
        self.longest = max(map(len, self.ids), default=1)
        self.worst = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        inner = [p.lstrip(MARK) for p in self.ids]
        self.splits = not any(MARK in p for p in inner)
        self.pairs: dict = {}
        # beginnings of pieces: True for those that are pieces themselves
        self.state = {p[:n]: False for p in self.ids for n in range(1, len(p))}
        self.state.update(dict.fromkeys(self.ids, True))

    def merged(self, text: str) -> list[str]:
        """Plain BPE on a short text: best-ranked neighbours first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.scores.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stays_apart(self, a: str, b: str) -> bool:
        key = (a, b)
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) > 1_200_000:
                self.pairs.clear()
            got = self.pairs[key] = self.merged(a + b) == [a, b]
        return got

    def whole(self, piece: str) -> bool:
        """Merging makes this piece out of its own characters."""
        if len(piece) < 2:
            return True
        key = ("", piece)
        if key not in self.pairs:
            self.pairs[key] = self.merged(piece) == [piece]
        return self.pairs[key]

    def out(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        if i is not None:
            return [i]
        if self.bytes:
            return [self.bytes[b] for b in piece.encode()]
        return [self.unknown]


class Stream:
    """Feeds characters in, gives out final pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.text = ""       # characters not given out yet, `text[0]` follows the last final boundary
        self.back = [0]      # backpointer of each position of `text` (0: the boundary)
        self.best = [0.0]
        self.before = ""     # the last piece given out
        self.live: list[int] = []
        self.lives: list[list[int]] | None = None  # `live` of every position, where wanted

    def _extend(self, chunk: str) -> None:
        """Add a few characters, each with its surviving edge.  `live` are the
        starts from which the text so far begins some piece."""
        v, text, back, best, live = self.v, self.text + chunk, self.back, self.best, self.live
        state, pairs, lives, bpe = v.state, v.pairs, self.lives, v.kind == "bpe"
        for i in range(len(self.text) + 1, len(text) + 1):
            still, at = [], -1
            score = 0.0 if bpe else best[i - 1] + v.worst
            for j in (*live, i - 1):
                piece = text[j:i]
                whole = state.get(piece)
                if whole is not None:
                    still.append(j)
                if bpe:
                    if at >= 0 or not (whole or j == i - 1):
                        continue
                    left = text[back[j]:j] if j else self.before
                    if left:
                        apart = pairs.get((left, piece))
                        if apart is None:
                            apart = v.stays_apart(left, piece)
                    else:
                        apart = v.whole(piece)
                    if apart:
                        at = j
                elif whole and best[j] + v.scores[piece] > score:
                    at, score = j, best[j] + v.scores[piece]
            live = still
            if lives is not None:
                lives.append(still)
            back.append(at if at >= 0 else i - 1)
            best.append(score)
        self.text, self.live = text, live

    def feed(self, text: str) -> list[str]:
        """Add characters; the pieces that have become final."""
        out, step = [], self.v.longest
        for at in range(0, len(text), step):
            self._extend(text[at:at + step])
            if len(self.text) >= 2 * step:
                out += self._settle()
        return out

    def _path(self, end: int) -> list[int]:
        path = [end]
        while path[-1] > 0:
            path.append(self.back[path[-1]])
        return path[::-1]

    def _settle(self) -> list[str]:
        """Give out what all paths of the window share."""
        n = len(self.text)
        live = range(max(0, n - self.v.longest + 1), n + 1)
        common = set(self._path(live[0]))
        for j in live[1:]:
            common &= set(self._path(j))
        return self._give(self._path(max(common)))

    def _give(self, path: list[int]) -> list[str]:
        pieces = [self.text[a:b] for a, b in zip(path, path[1:])]
        cut = path[-1]
        if cut:
            self.text = self.text[cut:]
            base = self.best[cut]
            self.back = [max(b - cut, 0) for b in self.back[cut:]]
            self.best = [s - base for s in self.best[cut:]]
            self.before = pieces[-1]
            self.live = [j - cut for j in self.live if j >= cut]
        return pieces

    def finish(self) -> list[str]:
        return self._give(self._path(len(self.text)))


class SortedWords(Stream):
    """Searches short texts one after the other, each from its own first boundary;
    positions shared with the text before are taken over."""

    def __init__(self, vocabulary: Vocabulary, codes: dict):
        super().__init__(vocabulary)
        self.lives = [self.live]
        self.codes = codes  # ids of the vocabulary's pieces, kept by the caller
        self.ids = [b""]    # ids of the path to each position

    def _code(self, piece: str) -> bytes:
        got = np.asarray(self.v.out(piece), "<i4").tobytes()
        if piece in self.v.ids:
            self.codes[piece] = got
        return got

    def search(self, word: str) -> bytes:
        n = 0
        for a, b in zip(self.text, word):
            if a != b:
                break
            n += 1
        back, ids, codes = self.back, self.ids, self.codes
        self.text = word[:n]
        del back[n + 1:], ids[n + 1:], self.best[n + 1:], self.lives[n + 1:]
        self.live = self.lives[n]
        self._extend(word[n:])
        for i in range(n + 1, len(word) + 1):
            j = back[i]
            piece = word[j:i]
            ids.append(ids[j] + (codes.get(piece) or self._code(piece)))
        return ids[-1]


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.known: dict = {}
        self.codes: dict = {}
        self._cut = re.compile(f"{MARK}*[^{MARK}]*") if vocabulary.splits else None

    @classmethod
    def of_worker(cls, path: str, kind: str) -> Encoder:
        have = worker_cache("pieces")
        if (path, kind) not in have:
            have[path, kind] = cls(Vocabulary(path, kind))
        return have[path, kind]

    def stream(self, chunks: Iterable[str]) -> Iterator[int]:
        """Ids of a text that arrives in chunks; memory stays with the window."""
        s, first = Stream(self.v), True
        for chunk in chunks:
            if not chunk:
                continue
            chunk = (MARK if first else "") + chunk.replace(" ", MARK)
            first = False
            for piece in s.feed(chunk):
                yield from self.v.out(piece)
        for piece in s.finish():
            yield from self.v.out(piece)

    def _search(self, marked: str) -> bytes:
        s = Stream(self.v)
        ids = [i for piece in s.feed(marked) + s.finish() for i in self.v.out(piece)]
        return np.asarray(ids, "<i4").tobytes()

    def _search_words(self, words: Iterable[str]) -> dict:
        """Ids of words that were not met before."""
        short = SortedWords(self.v, self.codes).search
        return {w: short(w) if len(w) <= CACHED_CHARS else self._search(w) for w in sorted(words)}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        marked = (MARK + t.replace(" ", MARK) if t else "" for t in texts)
        if self._cut is None:
            return [self._search(m) if m else b"" for m in marked]
        known, out, waiting, new = self.known, [], [], set()
        for row, m in enumerate(marked):
            words = self._cut.findall(m)[:-1]  # the last match is empty
            parts = list(map(known.get, words))
            if all(parts):
                out.append(b"".join(parts))
                continue
            open_at = [k for k, part in enumerate(parts) if part is None]
            unmet = [words[k] for k in open_at]
            new.update(unmet)
            out.append(b"")
            waiting.append((row, parts, open_at, unmet))
        coded = self._search_words(new)
        for row, parts, open_at, unmet in waiting:
            for k, word in zip(open_at, unmet):
                parts[k] = coded[word]
            out[row] = b"".join(parts)
        room = max(CACHED_WORDS - len(known), 0)
        known.update(islice(((w, c) for w, c in coded.items() if len(w) <= CACHED_CHARS), room))
        return out

    def encode(self, text: str) -> bytes:
        """Ids of one text."""
        return self.encode_all([text])[0]

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.v.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _groups(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of about GROUP_BYTES of text, a larger text alone."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(upto[at - 1]) if at else 0
        end = max(int(np.searchsorted(upto, before + GROUP_BYTES, "right")), at + 1)
        yield batch.slice(at, end - at)
        at = end


def encode_documents(docs: DataFrame, path: str, kind: str = "bpe", text: str = "text") -> DataFrame:
    """`docs` without the text, with `ids`, `n_ids`, `ids_crc32` (little-endian
    32-bit ids) and `round_trip` (decoding the ids gives the text again)."""
    new = ("ids", "n_ids", "ids_crc32", "round_trip")
    keep = [f for f in docs.schema.fields if f.name != text and f.name not in new]

    def emit(batch):
        encoder = Encoder.of_worker(path, kind)
        for b in _groups(batch, text):
            texts = [t or "" for t in b.column(text).to_pylist()]
            coded = encoder.encode_all(texts)
            sizes = np.fromiter((len(c) // 4 for c in coded), np.int64, len(coded))
            ids = np.frombuffer(b"".join(coded), "<i4")
            ends = np.concatenate(([0], np.cumsum(sizes)))
            same = [encoder.decode(ids[x:y].tolist()) == t for x, y, t in zip(ends, ends[1:], texts)]
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in keep], lists, pa.array(sizes),
                 pa.array([zlib.crc32(c) for c in coded], pa.int64()), pa.array(same)],
                [*[f.name for f in keep], *new])

    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in keep]
    return arrow_apply(docs.select(*[f.name for f in keep], text), emit,
                       ", ".join([*own, "ids array<int>", "n_ids long", "ids_crc32 long", "round_trip boolean"]))


def decode_documents(coded: DataFrame, path: str, kind: str = "bpe", ids: str = "ids") -> DataFrame:
    """`coded` with `text`, decoded from its ids; null ids give an empty text."""
    keep = [f for f in coded.schema.fields if f.name != "text"]

    def emit(batch):
        encoder = Encoder.of_worker(path, kind)
        texts = [encoder.decode(x or ()) for x in batch.column(ids).to_pylist()]
        yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in keep], pa.array(texts, pa.string())],
                                         [*[f.name for f in keep], "text"])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return arrow_apply(coded.select(*[f.name for f in keep]), emit, f"{own}, text string")
