"""Packing documents into fixed-length token sequences along a Hilbert curve.

Each document becomes a hashed word-count vector that is projected with random
signs to DIMENSIONS coordinates; their Hilbert key puts similar documents next
to each other.  Spark range-sorts the documents by that key (doc_id and checksum
break ties, so copies spread over partitions), and every range partition lays its
documents end to end into sequences of LENGTH ids.  The last, unfinished sequence
of a partition is cut into sequences whose sizes are powers of two, which need
no padding.

The word `tokenizers` vocabulary never joins characters across white space, so
a word's ids are computed once per worker and looked up afterwards.

Defined results: null text is an empty document, which is its end id alone;
repeated rows are packed once each; a null doc_id sorts first; an empty table
gives no pieces; clashing extra columns are ignored (only doc_id and text are
read); a document longer than a sequence continues in the next one.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from collections.abc import Collection
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import U64, mix, saved, text_batches, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 4096
END_ID = 2
DIMENSIONS = 4
KEY_BITS = 15  # bits of each coordinate: 60 in the key
CACHED_WORDS = 400_000
CACHED_WORD_CHARS = 48
KEY_BYTES = 1 << 18  # text bytes handled by one numpy pass over the words
ENDS = ".,;:!?"
PARTITION_SHIFT = 40  # sequence_id = partition << 40 | number in the partition

def project(word_hash: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """DIMENSIONS coordinates in [-1, 1] per document: every word votes with a
    sign bit of its hash, divided by the number of words."""
    h = mix(word_hash)
    n = np.maximum(np.bincount(doc, minlength=docs), 1)
    out = np.empty((docs, DIMENSIONS))
    for d in range(DIMENSIONS):
        signs = ((h >> U64(d)) & U64(1)).astype(np.float64) * 2 - 1
        out[:, d] = np.bincount(doc, weights=signs, minlength=docs) / n
    return out


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert key of integer points (rows of `cells`, each below 2**bits):
    the Gray-code form, all points at once."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for d in range(dims):
            up = (x[d] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] ^= swap
        q >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> b) & 1)
    return key


def curve_keys(texts: pa.Array) -> np.ndarray:
    keys = np.zeros(len(texts), np.int64)
    top = (1 << KEY_BITS) - 1
    for a, b, batch in text_batches(texts, KEY_BYTES):
        low = batch.lowered()
        start, end, doc = low.words()
        at = project(low.word_hashes(start, end), doc, low.n)
        keys[a:b] = hilbert(np.round((at + 1) / 2 * top).astype(np.int64), KEY_BITS)
    return keys


class Encoder:
    """Ids of a text as little-endian 32-bit bytes, word by word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict = {}
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        self.letters = self._letters()
        self.plain = re.compile("[" + "".join(map(chr, self.letters)) + "]+").fullmatch if self.letters else lambda w: None
        self.marks = {c: np.asarray(ids(c), "<u4").tobytes() for c in ENDS} if self.letters else {}

    def _letters(self) -> dict:
        """How the tokenizer spells the letters of ASCII and Latin-1 for its merges;
        empty where it does not treat them one by one or keeps end marks with them."""
        letters = "".join(c for c in map(chr, range(0x100)) if c.isalpha() and c.lower() != c.upper() and len(c.upper()) == 1)
        norm, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if norm is None or cut is None or any(t.isalpha() for t in self.added):
            return {}
        spell = {ord(c): "".join(p for p, _ in cut.pre_tokenize_str(norm.normalize_str(c))) for c in letters}
        for probe in (letters, letters[::-1]):
            pieces = [p for p, _ in cut.pre_tokenize_str(norm.normalize_str(probe))]
            if pieces != [probe.translate(spell)] or any(
                    [p for p, _ in cut.pre_tokenize_str(norm.normalize_str(probe + c))] != [*pieces, c] for c in ENDS):
                return {}
        return spell

    @classmethod
    def of_worker(cls, path: str) -> Encoder:
        have = worker_cache("packing")
        if path not in have:
            have[path] = cls(path)
        return have[path]

    def _new(self, words: list) -> dict:
        """Ids of words not seen before, many in one call of the tokenizer."""
        if any(token in w for token in self.added for w in words):
            coded = self.tokenizer.encode_batch(words, add_special_tokens=False)
            return {w: np.asarray(e.ids, "<u4").tobytes() for w, e in zip(words, coded)}
        coded = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        ids = np.asarray(coded.ids, "<u4").tobytes()
        ends = 4 * np.searchsorted(np.asarray(coded.word_ids, np.int64), np.arange(len(words) + 1))
        ends = ends.tolist()
        return {w: ids[x:y] for w, x, y in zip(words, ends, ends[1:])}

    def _spelled(self, words: Collection) -> dict:
        """Ids of words of plain letters, straight from the merges: `letters` gives
        each as the tokenizer spells it for them."""
        tokens, spell = self.tokenizer.model.tokenize, self.letters
        ids = [[t.id for t in tokens(w.translate(spell))] for w in words]
        raw = np.fromiter(chain.from_iterable(ids), "<u4").tobytes()
        ends = (4 * np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))).tolist()
        return {w: raw[x:y] for w, x, y in zip(words, [0, *ends], ends)}

    def _open(self, words: Collection) -> dict:
        """Ids of words not seen before.  One with an end mark behind its letters is
        cut there, as the tokenizer does."""
        known, plain = self.words, self.plain
        heads = {w: w[:-1] for w in words if w[-1] in self.marks and plain(w[:-1])}
        coded = self._spelled(set(heads.values()).difference(known))
        others = [w for w in words if w not in heads and w not in coded]
        coded.update(self._spelled([w for w in others if plain(w)]))
        rest = [w for w in others if w not in coded]
        for at in range(0, len(rest), 4096):
            coded.update(self._new(rest[at:at + 4096]))
        marks = self.marks
        for w, head in heads.items():
            coded[w] = (coded[head] if head in coded else known[head]) + marks[w[-1]]
        return coded

    def encode_all(self, texts: list | pa.Array) -> list:
        """Texts are split and their words told apart by Arrow; ids are looked up once
        for each different word of the batch."""
        column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        split = pc.ascii_split_whitespace(column.fill_null(""))
        spread = split.flatten().dictionary_encode()
        words, known = spread.dictionary.to_numpy(zero_copy_only=False).tolist(), self.words
        coded = self._open([w for w in words if w and w not in known])
        coded[""] = b""  # beside white space at the ends
        known.update(coded)
        ids = pa.array(list(map(known.__getitem__, words)), pa.large_binary()).take(spread.indices)
        for w in [w for w in coded if len(w) > CACHED_WORD_CHARS]:
            del known[w]
        if len(known) > CACHED_WORDS:  # the third met longest ago goes
            self.words = dict(islice(known.items(), len(known) - CACHED_WORDS * 2 // 3, None))
        _, ends, data = ids.buffers()
        ends = np.frombuffer(ends, np.int64)[:len(ids) + 1]
        ends = ends[np.concatenate(([0], np.cumsum(split.value_lengths().to_numpy())))].tolist()
        raw = memoryview(data) if data is not None else memoryview(b"")
        return [bytes(raw[x:y]) for x, y in zip(ends, ends[1:])]


class Packer:
    """Lays documents end to end; keeps the pieces of the unfinished sequence only."""

    def __init__(self, partition: int, length: int):
        self.length, self.next_id = length, partition << PARTITION_SHIFT
        self.open, self.fill = [], 0  # pieces (doc_id, start, ids, doc_tokens)

    def _emit(self, pieces) -> list:
        out, offset = [], 0
        for doc_id, start, ids, total in pieces:
            out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next_id, offset, ids))
            offset += len(ids)
        self.next_id += 1
        return out

    def add(self, doc_id, ids: np.ndarray) -> list:
        out, at = [], 0
        while at < len(ids):
            take = min(self.length - self.fill, len(ids) - at)
            self.open.append((doc_id, at, ids[at:at + take], len(ids)))
            self.fill += take
            at += take
            if self.fill == self.length:
                out += self._emit(self.open)
                self.open, self.fill = [], 0
        return out

    def close(self) -> list:
        out, size = [], 1 << max(self.fill.bit_length() - 1, 0)
        pieces = self.open
        while pieces:
            if size > self.fill:
                size >>= 1
                continue
            room, now, later = size, [], []
            for doc_id, start, ids, total in pieces:
                take = min(room, len(ids))
                if take:
                    now.append((doc_id, start, ids[:take], total))
                if take < len(ids):
                    later.append((doc_id, start + take, ids[take:], total))
                room -= take
            out += self._emit(now)
            pieces, self.fill = later, self.fill - size
        self.open = []
        return out


PIECE = ("doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """Pieces of all documents (doc_id, text); `with_ids` adds the ids themselves."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def keyed(batches):
        for b in batches:
            texts = b.column("text")
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), texts, pa.array(curve_keys(texts), pa.int64())], ["doc_id", "text", "curve"])

    def lay(batches):
        encoder = Encoder.of_worker(tokenizer_path)
        packer = Packer(TaskContext.get().partitionId(), length)
        end = np.asarray([end_id], "<u4").tobytes()

        def rows_of(rows):
            cols = list(zip(*rows))
            arrays = [pa.array(cols[0], id_type), *[pa.array(c, pa.int64()) for c in cols[1:7]]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                arrays.append(pa.array([i.astype(np.int32) for i in cols[7]], pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        id_type = pa.int64()
        for b in batches:
            id_type = b.schema.field("doc_id").type
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                coded = encoder.encode_all(some.column("text"))
                done = []
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), coded):
                    done += packer.add(doc_id, np.frombuffer(ids + end, "<u4"))
                if done:
                    yield rows_of(done)
        rest = packer.close()
        if rest:
            yield rows_of(rest)

    ordered = (docs.select("doc_id", "text").mapInArrow(keyed, f"doc_id {kind}, text string, curve long")
               .withColumn("_crc", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))))
    ordered = saved(ordered, "packing-keys")  # the bounds are sampled from the keys alone
    ordered = ordered.repartitionByRange("curve", "doc_id", "_crc").sortWithinPartitions("curve", "doc_id", "_crc")
    return ordered.select("doc_id", "text").mapInArrow(
        lay, PIECE.format(kind) + (", ids array<int>" if with_ids else ""))
