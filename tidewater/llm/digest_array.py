"""Sorted digest arrays: an exact, read-only map from strings to numbers kept in
shared files, probed by vectorised binary search.

Every term has the 64-bit xxHash that Spark's `xxhash64` gives it.  The hashes
are cut into shards by their top bits; one task sorts a shard and writes it as
one file in the shared folder: the sorted hashes, a payload number, and the
terms themselves.  A probing task maps a shard's file into memory, searches the
sorted hashes for a whole batch at once, and compares the stored term with the
one asked for, so two terms with one hash are told apart.  Nothing but one line
per shard passes through the driver; pages of the files are loaded as they are
touched and shared by all workers of a machine.

Defined results: null terms are left out; a term given more than once keeps its
largest payload; an empty table gives an array that finds nothing.  A term's
number is its place over all shards, from 0 without gaps.

The files lie under `spark.checkpoint.dir`.  Where that is no mounted folder
(hdfs, s3, ...), a shard is read whole once per worker instead of mapped.
"""

from __future__ import annotations

import sys
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import saved, worker_cache
from tidewater.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD_TERMS = 1 << 20  # terms of one shard; more terms make more shards
SEED = 42  # the seed of Spark's xxhash64


def _store(path: str):
    """File system and path of a Hadoop-style address."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@dataclass(frozen=True)
class Shard:
    number: int
    size: int
    first: int  # the number of its first term
    path: str


class _Open:
    """One shard's file as arrays: n, hashes, payloads, n + 1 offsets, terms."""

    def __init__(self, path: str):
        store, place = _store(path)
        if isinstance(store, fs.LocalFileSystem):
            raw = np.memmap(place, np.uint8, "r")
        else:
            with store.open_input_file(place) as f:
                raw = np.frombuffer(f.read(), np.uint8)
        n = int(raw[:8].view(np.int64)[0])
        part = lambda at, size: raw[8 * at:8 * (at + size)]
        self.hashes = part(1, n).view(np.uint64)
        self.payload = part(1 + n, n).view(np.int64)
        offsets, texts = part(1 + 2 * n, n + 1), raw[8 * (3 * n + 2):]
        self.terms = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(texts)])


def _write(path: str, table: pa.Table) -> pa.Table:
    number = table["shard"][0].as_py()
    table = table.combine_chunks()
    hashes = table["hash"].combine_chunks().to_numpy().view(np.uint64)
    order = np.argsort(hashes, kind="stable")
    terms = table["term"].cast(pa.large_binary()).combine_chunks().take(pa.array(order))
    lengths = np.concatenate([[0], np.cumsum(pc.binary_length(terms).to_numpy().astype(np.int64))])
    texts = terms.buffers()[2]
    # a file of this attempt's own: the manifest names the one that counts
    place = f"{path}/{number:06d}-{uuid.uuid4().hex}.digests"
    store, at = _store(place)
    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(at) as f:
        for part in (np.array([len(hashes)]), hashes[order], table["payload"].combine_chunks().to_numpy()[order], lengths):
            f.write(np.ascontiguousarray(part).view(np.uint8).tobytes())
        if texts is not None:
            f.write(texts)
    return pa.table({"shard": [number], "size": [len(hashes)], "path": [place]})


class DigestArray:
    """Handle of a written array; tasks carry it and open the shards they need."""

    def __init__(self, bits: int, shards: list[Shard]):
        self.bits, self.shards = bits, {s.number: s for s in shards}
        self.size = sum(s.size for s in shards)
        self._bases = np.array([s.first for s in shards], np.int64)
        self._numbers = [s.number for s in shards]

    def open(self, number: int) -> _Open | None:
        shard = self.shards.get(number)
        if shard is None:
            return None
        cache = worker_cache("digest-arrays")
        if shard.path not in cache:
            cache[shard.path] = _Open(shard.path)
        return cache[shard.path]

    def find(self, hashes: np.ndarray, terms: pa.Array) -> np.ndarray:
        """The number of each term, -1 for those that are not stored."""
        out = np.full(len(hashes), -1, np.int64)
        hashes = hashes.view(np.uint64)
        terms = terms.cast(pa.large_binary())
        shard_of = hashes >> np.uint64(64 - self.bits) if self.bits else np.zeros(len(hashes), np.uint64)
        for number in np.unique(shard_of):
            shard = self.open(int(number))
            if shard is None:
                continue
            rows = np.flatnonzero(shard_of == number)
            at = np.searchsorted(shard.hashes, hashes[rows])
            while len(rows):  # once, and again for terms that share their hash with another
                near = np.minimum(at, len(shard.hashes) - 1)
                same = (at < len(shard.hashes)) & (shard.hashes[near] == hashes[rows])
                rows, at = rows[same], at[same]
                if not len(rows):
                    break
                right = pc.equal(shard.terms.take(pa.array(at)), terms.take(pa.array(rows))).to_numpy(zero_copy_only=False)
                out[rows[right]] = at[right] + self.shards[int(number)].first
                rows, at = rows[~right], at[~right] + 1
        return out

    def _each(self, numbers: np.ndarray):
        where = np.searchsorted(self._bases, numbers, "right") - 1
        for k in np.unique(where):
            rows = np.flatnonzero(where == k)
            yield rows, numbers[rows] - self._bases[k], self.open(self._numbers[k])

    def payloads(self, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(numbers), np.int64)
        for rows, at, shard in self._each(numbers):
            out[rows] = shard.payload[at]
        return out

    def terms(self, numbers: np.ndarray) -> pa.Array:
        """The terms of these numbers as strings, in this order."""
        parts, rows = [], []
        for r, at, shard in self._each(numbers):
            rows.append(r)
            parts.append(shard.terms.take(pa.array(at)))
        if not parts:
            return pa.array([], pa.large_string())
        back = np.argsort(np.concatenate(rows), kind="stable")
        return pa.concat_arrays(parts).take(pa.array(back)).cast(pa.large_string())


def build(df: DataFrame, term: str, payload: str, name: str, shard_terms: int = SHARD_TERMS) -> DigestArray:
    """Write the array of the distinct terms in `df`."""
    rows = df.where(F.col(term).isNotNull()).groupBy(F.col(term).cast("string").alias("term")).agg(
        F.max(F.col(payload).cast("long")).alias("payload"))
    rows = saved(rows.select(F.xxhash64("term").alias("hash"), "term", F.coalesce("payload", F.lit(0)).alias("payload")),
                 f"{name}-terms")
    bits = max(0, int(rows.count() - 1) // shard_terms).bit_length()
    shard = F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0).cast("long")
    path = scratch_path(df.sparkSession, name)
    made = rows.withColumn("shard", shard).groupBy("shard").applyInArrow(
        lambda table: _write(path, table), "shard long, size long, path string")
    shards, first = [], 0
    for r in sorted(made.collect()):  # one line for every `shard_terms` terms
        shards.append(Shard(r["shard"], r["size"], first, r["path"]))
        first += r["size"]
    return DigestArray(bits, shards)
