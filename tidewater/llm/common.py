"""Helpers shared by the operators of this package.

* `saved` cuts lineage with a written table in the cluster's shared folder;
  `dropped` removes such tables when no later step reads them.
* `Batch` holds many texts as one byte buffer, so word splitting and hashing
  are numpy passes over the buffer and not Python loops over words.
* `hash_bitmap` is a fixed-size set of 64-bit hashes.  Its size (2**bits
  bits) does not grow with the data, so it may be broadcast; it only
  prefilters (no false negatives), an exact step always follows.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

U64 = np.uint64
CHUNK_BYTES = 2 << 20  # text bytes handled by one numpy pass

#: The white space of the word pattern [^\x20\x09-\x0D]+
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside give their shuffle files back as they end."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: no lineage behind it,
    so a lost executor costs a read and not a recomputation, and the shuffle
    files of the step are needed no more."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Remove the folders of tables that `saved` returned.  Whatever was made of
    them must be written by then, as a frame that still reads them would fail."""
    for t in tables:
        spark = t.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(t._scratch)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def signed(a: np.ndarray) -> np.ndarray:
    return a.astype(U64, copy=False).view(np.int64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every output bit depends on all input bits."""
    h = h.astype(U64, copy=True)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << U64(bits)) | (x >> U64(64 - bits))


# --- fixed values: the primes of the XXH64 hash --------------------------------
XX1, XX2, XX3, XX4, XX5 = (U64(0x9E3779B185EBCA87), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9),
                           U64(0x85EBCA77C2B2AE63), U64(0x27D4EB2F165667C5))
# --------------------------------------------------------------------------------


def xxhash64(values: np.ndarray, seed) -> np.ndarray:
    """XXH64 of 64-bit numbers, as Spark's function of that name computes it for
    a long column (seed 42, or the hash of the columns before)."""
    with np.errstate(over="ignore"):
        h = (seed + XX5 + U64(8)) ^ (_turn(values.astype(U64) * XX2, 31) * XX1)
        h = _turn(h, 27) * XX1 + XX4
        h = (h ^ (h >> U64(33))) * XX2
        h = (h ^ (h >> U64(29))) * XX3
        return h ^ (h >> U64(32))


class Rolling:
    """Hashes of any slice of a byte or word buffer from one running sum.

    H(s, e) = sum(table[x_k] * B**(k-s)) modulo 2**64 for odd B, then mixed.

    Only for slices of bounded length: from 2,048 values on, sequences that differ
    in the Thue-Morse pattern have one hash whatever the table and base are.  Whole
    texts and word sequences are named by `digests`, long words as well.
    """

    _powers: dict = {}

    def __init__(self, seed: int):
        rng = np.random.RandomState(seed)
        draw = lambda n: (rng.randint(0, 1 << 32, n, dtype=np.uint64) << U64(32)) | rng.randint(0, 1 << 32, n, dtype=np.uint64)
        self.table = draw(256)
        self.base = int(draw(1)[0]) | 1
        self.inverse = pow(self.base, -1, 1 << 64)

    def _pow(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = Rolling._powers.get(self.base)
        if have is None or len(have[0]) < n:
            size = max(n, 1 << 16)
            have = tuple(_power_table(b, size) for b in (self.base, self.inverse))
            if size <= CHUNK_BYTES * 2:
                Rolling._powers[self.base] = have
        return have

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Running sums (one longer than `values`); bytes go through the table."""
        v = self.table[values] if values.dtype == np.uint8 else values
        out = np.zeros(len(v) + 1, U64)
        np.cumsum(v * self._pow(len(v) + 1)[0][: len(v)], out=out[1:])
        return out

    def slices(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        inv = self._pow(len(sums))[1]
        return mix((sums[end] - sums[start]) * inv[start])


def _power_table(base: int, n: int) -> np.ndarray:
    out = np.ones(n, U64)
    done = 1
    with np.errstate(over="ignore"):
        while done < n:
            step = min(done, n - done)
            out[done:done + step] = out[:step] * U64(pow(base, done, 1 << 64))
            done += step
    return out


WORD_HASH = Rolling(11)
LONG_WORD = 256  # bytes from which on a word is named by its digest


def digests(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits of a cryptographic digest of each slice of a buffer."""
    raw = np.ascontiguousarray(values).view(np.uint8).data
    w = values.dtype.itemsize
    return np.frombuffer(b"".join([hashlib.blake2b(raw[s * w:e * w], digest_size=8).digest()
                                   for s, e in zip(start.tolist(), end.tolist())]), U64)


class Batch:
    """Texts as one byte buffer with offsets (`text i` = data[offs[i]:offs[i+1]])."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs = data, offs

    @property
    def n(self) -> int:
        return len(self.offs) - 1

    def lowered(self) -> Batch:
        """A-Z to a-z, as a byte table."""
        return Batch(LOWER[self.data], self.offs)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text index of every word of `[^\\x20\\x09-\\x0D]+`."""
        w = ~SPACE[self.data]
        if not len(w):
            e = np.zeros(0, np.int64)
            return e, e, e
        before = np.empty_like(w)
        before[0], before[1:] = False, w[:-1]
        firsts = self.offs[:-1]
        before[firsts[firsts < len(w)]] = False
        after = np.empty_like(w)
        after[-1], after[:-1] = False, w[1:]
        ends = self.offs[1:]
        after[ends[ends > 0] - 1] = False
        start = np.flatnonzero(w & ~before)
        end = np.flatnonzero(w & ~after) + 1
        return start, end, np.searchsorted(self.offs, start, "right") - 1

    def word_hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = WORD_HASH.slices(WORD_HASH.sums(self.data), start, end)
        long = np.flatnonzero(end - start >= LONG_WORD)
        if len(long):
            out[long] = digests(self.data, start[long], end[long])
        return out


def text_batches(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Batch]]:
    """(first row, row after the last, Batch) in pieces of about `limit` bytes;
    a longer text is a piece of its own.  Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset: column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        last = max(int(np.searchsorted(offs, offs[row] + limit, "right")) - 1, row + 1)
        last = min(last, n)
        yield row, last, Batch(data[offs[row]:offs[last]], (offs[row:last + 1] - offs[row]).astype(np.int64))
        row = last


def windows_of(index: np.ndarray, n: int) -> np.ndarray:
    """Positions i where items i .. i+n-1 belong to the same text."""
    m = len(index) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(index[:m] == index[n - 1:])


def window_hashes(values: np.ndarray, at: np.ndarray, n: int, rolling: Rolling) -> np.ndarray:
    return rolling.slices(rolling.sums(values), at, at + n)


BITMAP_BITS = 27  # 16 MB


class HashBitmap:
    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def __contains__(self, h):  # pragma: no cover - use `has`
        raise TypeError("use has()")

    def has(self, h: np.ndarray) -> np.ndarray:
        cell = h.astype(U64, copy=False) >> U64(64 - self.bits)
        return (self.words[(cell >> U64(3)).astype(np.int64)] >> (cell & U64(7)).astype(np.uint8)) & 1 == 1


def hash_bitmap(df: DataFrame, col: str, bits: int = BITMAP_BITS):
    """Broadcast of the fixed-size bitmap over the top `bits` bits of the
    64-bit hashes in `col`: 2**bits / 8 bytes at any input size."""
    spark: SparkSession = df.sparkSession
    cell = F.shiftrightunsigned(F.col(col), 64 - bits) + 1
    with shuffles_freed(spark):  # the setting counts where the frame is made, not where it runs
        rows = (df.where(F.col(col).isNotNull())
                .select(F.bitmap_bucket_number(cell).alias("b"), F.bitmap_bit_position(cell).alias("p"))
                .groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits"))).collect()
    out = np.zeros(max((1 << bits) // 8, 4096), np.uint8)
    for r in rows:  # at most 2**bits / 32768 rows of 4 KB
        at = (r["b"] - 1) * 4096
        out[at:at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return spark.sparkContext.broadcast(HashBitmap(out, bits))


def arrow_apply(df: DataFrame, fn, schema: str) -> DataFrame:
    """mapInArrow over `fn(RecordBatch) -> iterator of RecordBatch`."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                yield from fn(b)
    return df.mapInArrow(run, schema)


def worker_cache(name: str) -> dict:
    """A dict that lives as long as this Python worker, over tasks and jobs."""
    home = sys.modules.setdefault("_tidewater_worker_cache", type(sys)("_tidewater_worker_cache"))
    return home.__dict__.setdefault(name, {})
