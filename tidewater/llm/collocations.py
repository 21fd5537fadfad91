"""Phrase collocations counted in quotient filters.

A phrase is packed from the numbers of its words and counted without loss:

1. Words are counted per language; those frequent enough to stand in a candidate
   (a phrase is no more frequent than any of its words) are numbered by a sorted
   digest array in shared files.  A number stands for one word of one language.
2. Each text becomes runs of numbers, broken at piece ends and at rare words.
3. Every task packs the phrases of its runs, permutes the packed number by a
   Feistel network (a bijection), and counts them in a `QuotientFilter`: sorted by
   the quotient (top bits), with occupied and run-end bits, the full remainder and
   a compact counter.  Nothing is hashed away: the permutation is inverted at the
   end.
4. The filters are cut at quotient bounds into shards and merged shard by shard as
   sorted sequences.  The permutation deals phrases evenly, and a phrase that makes
   up a third of all rows is one entry of each task's filter.

Scores are whole numbers, exact in 128-bit decimals.

Defined results: null texts are empty; null languages are `und`; A-Z are
lower-cased; a text is cut at `[.,;:!?\\x0A-\\x0D]` into pieces and these into words
`[^\\x20\\x09]+`; phrases do not cross pieces; repeated rows count again; an empty
table gives an empty table; other columns are ignored.  Long texts are counted
whole, in batches.  Ties of the rank: score, then a, both falling, then the phrase
in UTF-8 byte order.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import LOWER, Batch, saved, text_batches
from tidewater.llm.digest_array import SEED, DigestArray, build

cloudpickle.register_pickle_by_value(sys.modules[__name__])

U64 = np.uint64
#: Bytes that end a piece, and bytes that part words.
PIECE_END = np.zeros(256, bool)
PIECE_END[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True
GAP = PIECE_END.copy()
GAP[[0x20, 0x09]] = True

TEXT_BYTES = 2 << 20    # text bytes tokenised at once
SHARD_WORDS = 2 << 20   # words of the corpus for one shard of merged filters
TASK_PHRASES = 1 << 20  # phrases that a task gathers before it counts them
RANK_SALTS = 64
UNKNOWN_LANG = "und"


# --- words -------------------------------------------------------------------------
def _words(batch: Batch):
    """Distinct words (strings), the number of each word in text order, its text,
    and whether it begins a piece."""
    data = LOWER[batch.data]
    inside = ~GAP[data]
    edge = np.zeros(len(data) + 1, bool)  # a text's first byte begins a word and a piece
    edge[batch.offs] = True
    start = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], ~inside[:-1]])))
    if not len(start):
        return pa.array([], pa.large_string()), start, start, start.astype(bool)
    run = np.cumsum(inside)
    lengths = np.diff(np.concatenate([run[start] - 1, run[-1:]]))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    coded = words.dictionary_encode()
    text = np.searchsorted(batch.offs, start, "right") - 1
    ends = np.cumsum(PIECE_END[data])[start]
    begins = np.ones(len(start), bool)
    begins[1:] = (text[1:] != text[:-1]) | (ends[1:] != ends[:-1])
    return coded.dictionary, coded.indices.to_numpy(), text, begins


def _by_lang(words: np.ndarray, n_words: int, text: np.ndarray, langs: pa.Array):
    """Language number of each text, the languages, and one key per (language, word)."""
    coded = langs.dictionary_encode()
    lang = coded.indices.to_numpy()
    return coded.dictionary, lang[text].astype(np.int64) * max(n_words, 1) + words


def _langs(b: pa.RecordBatch) -> pa.Array:
    return b["lang"].cast(pa.string()).fill_null(UNKNOWN_LANG)


def _count_words(batches):
    for b in batches:
        langs = _langs(b)
        for lo, hi, texts in text_batches(b["text"], TEXT_BYTES):
            words, index, text, _ = _words(texts)
            if not len(index):
                continue
            names, keys = _by_lang(index, len(words), text, langs[lo:hi])
            key, n = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([
                names.take(pa.array(key // len(words))), words.take(pa.array(key % len(words))).cast(pa.string()),
                pa.array(n)], names=["lang", "word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n over all texts."""
    return (docs.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def _number_runs(vocabulary: DigestArray, batches):
    """Blocks of word numbers (from 1), 0 where a run breaks; little-endian bytes."""
    for b in batches:
        langs = _langs(b)
        for lo, hi, texts in text_batches(b["text"], TEXT_BYTES):
            words, index, text, begins = _words(texts)
            if not len(index):
                continue
            names, keys = _by_lang(index, len(words), text, langs[lo:hi])
            key, place = np.unique(keys, return_inverse=True)
            terms = pc.binary_join_element_wise(
                words.take(pa.array(key % len(words))), names.take(pa.array(key // len(words))).cast(pa.large_string()),
                pa.scalar("\t", pa.large_string()))
            hashes = np.array([xxhash.xxh64_intdigest(t, SEED) for t in terms.cast(pa.large_binary()).to_pylist()], U64)
            number = (vocabulary.find(hashes, terms) + 1)[place]
            # a zero before each word that begins a piece; rare words are zeros already
            at = np.arange(len(number)) + np.cumsum(begins)
            out = np.zeros(int(at[-1]) + 2, np.int64)
            out[at] = number
            near = np.concatenate([[0], out[:-1]]) + np.concatenate([out[1:], [0]])
            kept = (out > 0) & (near > 0)  # words with a frequent neighbour
            out[~kept] = 0
            out = out[kept | np.concatenate([[False], kept[:-1]])]  # one zero behind each run
            if len(out):
                yield pa.RecordBatch.from_arrays([pa.array([out.astype(_width(vocabulary)).tobytes()], pa.binary())],
                                                 names=["runs"])


def _width(vocabulary: DigestArray) -> str:
    return "<i8" if vocabulary.size >= 1 << 31 else "<i4"


# --- packed phrases and their permutation ------------------------------------------
class Packing:
    """Up to `words` word numbers below 2**bits as one number of two halves, permuted."""

    KEYS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)

    def __init__(self, size: int, words: int):
        self.words, self.bits = words, max(1, int(size).bit_length())
        self.half = -(-self.words * self.bits // 2)
        if self.half > 63:
            raise ValueError(f"{words} words of {self.bits} bits do not fit into two 63-bit halves")
        self.mask = U64((1 << self.half) - 1)

    def pack(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Columns of word numbers (0 behind the last word) as (high, low) halves."""
        high, low = np.zeros(len(columns[0]), U64), np.zeros(len(columns[0]), U64)
        for k, c in enumerate(columns):
            c, at = c.astype(U64), k * self.bits  # bits [at, at + bits) of the packed number
            if at < self.half:
                low |= (c << U64(at)) & self.mask
                if at + self.bits > self.half:
                    high |= c >> U64(self.half - at)
            else:
                high |= c << U64(at - self.half)
        return high, low

    def unpack(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        out, mask = [], U64((1 << self.bits) - 1)
        for k in range(self.words):
            at = k * self.bits
            if at < self.half:
                c = low >> U64(at)
                if at + self.bits > self.half:
                    c = c | (high << U64(self.half - at))
            else:
                c = high >> U64(at - self.half)
            out.append((c & mask).astype(np.int64))
        return out

    def _round(self, x: np.ndarray, key: int) -> np.ndarray:
        x = (x + U64(key)) * U64(0xD6E8FEB86659FD93)
        x ^= x >> U64(32)
        x *= U64(0xD6E8FEB86659FD93)
        return (x ^ (x >> U64(32))) & self.mask

    def permute(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for key in self.KEYS:
            high, low = low, high ^ self._round(low, key)
        return high, low

    def invert(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for key in reversed(self.KEYS):
            high, low = low ^ self._round(high, key), high
        return high, low


# --- the filter ----------------------------------------------------------------------
def _sorted_counts(high, low, count, half):
    """Entries in order, equal ones added up."""
    if 2 * half <= 64:  # both halves in one number
        both = (high << U64(half)) | low
        order = np.argsort(both, kind="stable")
        both = both[order]
        new = np.concatenate([[True], both[1:] != both[:-1]])
    else:
        order = np.lexsort((low, high))
        new = np.concatenate([[True], (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])])
    at = np.flatnonzero(new)
    return high[order][at], low[order][at], np.add.reduceat(count[order], at)


class QuotientFilter:
    """Counts of permuted numbers, kept by quotient.

    The high half's top bits are the quotient, its other bits and the low half the
    remainder, which is kept in full.  Entries lie in order of the quotient; one bit
    per quotient says that it is occupied, one bit per entry that it ends its run.
    A count of 1 to 254 takes one byte, a larger one 255 and eight more.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray, count: np.ndarray):
        self.high, self.low, self.count = high, low, count

    @classmethod
    def counted(cls, high, low, count, half: int) -> QuotientFilter:
        return cls(*(_sorted_counts(high, low, count, half) if len(high) else (high, low, count)))

    @classmethod
    def merged(cls, filters: list[QuotientFilter], half: int) -> QuotientFilter:
        """Sorted filters of one shard as one (the stable sort merges their runs)."""
        return cls.counted(*(np.concatenate([getattr(f, c) for f in filters]) for c in ("high", "low", "count")), half)

    def cut(self, shards: int, half: int):
        """(shard, filter): entries dealt by the top of the high half, at quotient bounds."""
        bounds = np.array([-(-(k << half) // shards) for k in range(1, shards)], U64)
        at = [0, *np.searchsorted(self.high, bounds).tolist(), len(self.high)]
        for k in range(shards):
            if at[k] < at[k + 1]:
                s = slice(at[k], at[k + 1])
                yield k, QuotientFilter(self.high[s], self.low[s], self.count[s])

    def encode(self, half: int) -> bytes:
        """A filter with entries as bytes: entries, remainder bits, first quotient and
        span; occupied bits, run-end bits, remainders, counters."""
        n = len(self.high)
        # about one quotient for each entry of the range that the entries span
        rest = (int(self.high[-1] - self.high[0]) // n).bit_length()
        quotient = self.high >> U64(rest)
        base = int(quotient[0])
        span = int(quotient[-1]) - base + 1
        occupied = np.zeros(span, bool)
        occupied[(quotient - U64(base)).astype(np.int64)] = True
        ends = np.ones(n, bool)
        ends[:-1] = quotient[1:] != quotient[:-1]
        head = np.array([n, rest, base, span], U64).tobytes()
        low_bytes, rest_bytes = -(-half // 8), -(-rest // 8)
        narrow = lambda a, w: a.astype("<u8").view(np.uint8).reshape(n, 8)[:, :w].tobytes()
        remainder = narrow(self.high & U64((1 << rest) - 1), rest_bytes) + narrow(self.low, low_bytes)
        big = self.count > 254
        counters = np.where(big, 255, self.count).astype(np.uint8).tobytes() + self.count[big].astype("<u8").tobytes()
        return head + np.packbits(occupied).tobytes() + np.packbits(ends).tobytes() + remainder + counters

    @classmethod
    def decode(cls, data: bytes, half: int) -> QuotientFilter:
        raw = np.frombuffer(data, np.uint8)
        n, rest, base, span = (int(x) for x in raw[:32].view(U64))
        at = 32

        def take(size):
            nonlocal at
            at += size
            return raw[at - size:at]

        def wide(w):
            out = np.zeros((n, 8), np.uint8)
            out[:, :w] = take(n * w).reshape(n, w)
            return out.reshape(-1).view(U64)

        occupied = np.unpackbits(take(-(-span // 8)), count=span)
        ends = np.unpackbits(take(-(-n // 8)), count=n)
        run = np.cumsum(ends) - ends  # number of the run that an entry lies in
        quotient = np.flatnonzero(occupied).astype(U64)[run] + U64(base)
        high = (quotient << U64(rest)) | wide(-(-rest // 8))
        low = wide(-(-half // 8))
        count = take(n).astype(np.int64)
        big = count == 255
        count[big] = take(8 * int(big.sum())).copy().view("<u8").astype(np.int64)
        return cls(high, low, count)


def _count_phrases(packing: Packing, shards: int, width: str, batches):
    """Filters of this task's phrases of 2 words up to `packing.words`, cut into shards."""
    def counted(parts):
        high, low = (np.concatenate(x) for x in zip(*parts))
        return QuotientFilter.counted(high, low, np.ones(len(high), np.int64), packing.half)

    parts, size = [], 0

    def out():
        for k, f in counted(parts).cut(shards, packing.half):
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([f.encode(packing.half)], pa.binary())],
                                             names=["shard", "filter"])

    for b in batches:
        for data in b["runs"]:
            ids = np.frombuffer(data.as_py(), width).astype(np.int64)
            at = np.flatnonzero(ids[:-1] > 0)
            for n in range(2, packing.words + 1):  # a run has a zero behind it, so at + n - 1 stays inside
                at = at[ids[at + n - 1] > 0]
                columns = [ids[at + k] if k < n else np.zeros(len(at), np.int64) for k in range(packing.words)]
                parts.append(packing.permute(*packing.pack(columns)))
                size += len(at)
            if size >= TASK_PHRASES:
                yield from out()
                parts, size = [], 0
    if parts:
        yield from out()


def _merge(packing: Packing, vocabulary: DigestArray, least: int, table: pa.Table) -> pa.Table:
    """One shard: its filters merged, frequent phrases unpacked into words and counts."""
    merged = QuotientFilter.merged([QuotientFilter.decode(f.as_py(), packing.half) for f in table["filter"]], packing.half)
    hit = merged.count >= least
    ids = packing.unpack(*packing.invert(merged.high[hit], merged.low[hit]))
    size = sum((c > 0).astype(np.int64) for c in ids)
    columns, lang = {"a": pa.array(merged.count[hit]), "size": pa.array(size)}, None
    for k, c in enumerate(ids):
        there = np.flatnonzero(c > 0)
        number = c[there] - 1
        words = [t.split("\t", 1) for t in vocabulary.terms(number).to_pylist()]  # a word holds no tab
        word, n = np.full(len(c), None, object), np.zeros(len(c), np.int64)
        word[there], n[there] = [w for w, _ in words], vocabulary.payloads(number)
        if not k:
            lang = pa.array([x for _, x in words], pa.string())
        columns |= {f"i{k + 1}": pa.array(c), f"w{k + 1}": pa.array(word, pa.string()), f"n{k + 1}": pa.array(n)}
    return pa.table({"lang": lang, **columns})


# --- the operator --------------------------------------------------------------------
def phrase_counts(docs: DataFrame, words: DataFrame, least: int, max_words: int = 3) -> DataFrame:
    """Phrases of 2 to `max_words` words found at least `least` times: lang, a, size and
    for each word its number (i1, ...), text (w1, ...) and count (n1, ...).
    `words` are the `word_counts` of `docs`."""
    total = words.agg(F.sum("n")).first()[0] or 0
    vocabulary = build(words.where(F.col("n") >= least).select(F.concat_ws("\t", "word", "lang").alias("term"), "n"),
                       "term", "n", "phrase-vocabulary")
    packing, width = Packing(vocabulary.size, max_words), _width(vocabulary)
    shards = max(1, -(-int(total) // SHARD_WORDS))
    runs = saved(docs.select("lang", "text").mapInArrow(lambda b: _number_runs(vocabulary, b), "runs binary"), "phrase-runs")
    filters = runs.mapInArrow(lambda b: _count_phrases(packing, shards, width, b), "shard long, filter binary")
    schema = "lang string, a long, size long" + "".join(
        f", i{k} long, w{k} string, n{k} long" for k in range(1, max_words + 1))
    return saved(filters.groupBy("shard").applyInArrow(lambda t: _merge(packing, vocabulary, least, t), schema),
                 "phrase-counts")


def _score(a, left, right):
    d = lambda c: F.col(c).cast("decimal(38,0)")
    top, under = d(a) * d(a) * F.lit(1_000_000).cast("decimal(38,0)"), d(left) * d(right)
    return F.call_function("div", top, under)


def _best(rows: DataFrame, top: int, *by) -> DataFrame:
    """The first `top` rows of each group with their rank.  A language with a third
    of all phrases is ranked within salts first, so few of its rows meet in one task."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, inside_percent: int = 50) -> DataFrame:
    """Phrases of 2 to 3 words per language by how much more often their words stand
    together than apart: lang, rank, phrase, a, l, r, n, score.  A phrase that lies in
    a longer one with at least `inside_percent` of its count is left out."""
    words = saved(word_counts(docs), "phrase-words")
    found = phrase_counts(docs, words, least)
    pairs = found.where("size = 2").select("lang", "i1", "i2", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a",
                                           F.col("n1").alias("l"), F.col("n2").alias("r"))
    triples = found.where("size = 3").select("lang", "i1", "i2", "i3", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
                                             "a", F.col("n1").alias("l1"), F.col("n3").alias("r2"))
    # parts of a frequent phrase are frequent, so both pairs of a triple are found
    first, last = (found.where("size = 2").select(F.col("i1").alias(x), F.col("i2").alias(y), F.col("a").alias(n))
                   for x, y, n in (("i1", "i2", "l2"), ("i2", "i3", "r1")))
    cuts = triples.join(first, ["i1", "i2"]).join(last, ["i2", "i3"])
    cut = F.when(_score("a", "l1", "r1") <= _score("a", "l2", "r2"), F.struct(F.col("l1").alias("l"), F.col("r1").alias("r")))
    triple_rows = cuts.withColumn("_c", cut.otherwise(F.struct(F.col("l2").alias("l"), F.col("r2").alias("r")))).select(
        "lang", "phrase", "a", "_c.l", "_c.r")
    longer = (triples.select(F.explode(F.array(F.struct(F.col("i1"), F.col("i2")), F.struct(F.col("i2").alias("i1"), F.col("i3").alias("i2"))))
                             .alias("p"), "a").groupBy("p.i1", "p.i2").agg(F.max("a").alias("_longer")))
    alone = pairs.join(longer, ["i1", "i2"], "left").where(
        F.col("_longer").isNull() | (100 * F.col("_longer") < inside_percent * F.col("a")))
    rows = alone.select("lang", "phrase", "a", "l", "r").unionByName(triple_rows).withColumn("score", _score("a", "l", "r"))
    best = _best(_best(rows, top, "lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS))), top, "lang")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
