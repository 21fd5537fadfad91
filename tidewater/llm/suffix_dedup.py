"""Exact substring dedup by distributed prefix doubling over byte positions.

Every text position that starts a WINDOW-byte string is ranked by the string that
follows it; Spark groups equal ranks at growing lengths, drops positions whose
rank has become unique and stops at WINDOW bytes.  Ranks are names (64-bit
fingerprints of the ranked bytes), so no round has to sort all suffixes again.

Two things keep the rounds small.  (1) The first rank is taken at chosen
positions only: of the PREFIX-byte strings in each window, the one with the
smallest hash.  Equal windows choose the same one at the same distance, so a
window whose chosen string occurs once is unique and is dropped with it.  (2) The
windows that share a chosen position form a run of neighbouring starts.  What all
windows of a run have in common (its core) serves as the rank, and what they
cover together (its span) as the threshold test: equal spans mean that every
window of the run repeats; a unique core means that none does; all other runs are
cut into shorter ones, whose cores are longer, down to single windows.

    run length 137 -> 28 -> 6 -> 1,  ranked bytes 64 -> 173 -> 195 -> 200

Equal spans go on as one representative, so large groups of copies cost one row.

Defined results: null text is empty; matches never cross texts, nor cut a text
short; overlapping occurrences count; a text of under WINDOW bytes keeps all its
bytes; a text that occurs again as a whole (WINDOW bytes or more) is removed as a
whole; repeated rows are texts of their own; a null doc_id stays null; an empty
table gives an empty table; only doc_id and text are read; long texts are read whole.  Texts are equal
when 64 bits of a cryptographic digest are, strings when two independent 64-bit
fingerprints are.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import (U64, Batch, Rolling, arrow_apply, digests, hash_bitmap, mix, saved, signed, text_batches,
                                  xxhash64)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 200
PREFIX = 64
RUN = WINDOW - PREFIX + 1  # starts that can share a chosen position
STEPS = (28, 6, 1)

CORE = Rolling(31)
SPAN = Rolling(37)


def text_keys(batch: Batch) -> np.ndarray:
    return digests(batch.data, batch.offs[:-1], batch.offs[1:])


def position_keys(text_key: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The value of Spark's xxhash64(txt, a)."""
    return xxhash64(at.astype(U64), xxhash64(text_key, U64(42)))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def chosen(batch: Batch) -> dict | None:
    """The chosen positions of all windows of a batch, as columns: text index
    `doc`, position `a`, `core`, and the distances `lo`..`hi` from window starts
    to the position; None when no text is long enough."""
    sizes = np.diff(batch.offs)
    long = np.flatnonzero(sizes >= WINDOW)
    if not len(long):
        return None
    n = len(batch.data)
    sums = CORE.sums(batch.data)
    grams = CORE.slices(sums, np.arange(n - PREFIX + 1), np.arange(PREFIX, n + 1))
    bits = max(22, int(n).bit_length())
    low = U64((1 << bits) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=U64)
    least = _sliding_min(key, RUN)
    edge = np.zeros(len(least) + 1, np.int64)
    np.add.at(edge, batch.offs[:-1][long], 1)
    np.add.at(edge, batch.offs[1:][long] - WINDOW + 1, -1)
    start = np.flatnonzero(np.cumsum(edge)[:-1] > 0)
    at = (least[start] & low).astype(np.int64)
    head = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    tail = np.concatenate((head[1:] - 1, [len(at) - 1]))
    a = at[head]
    doc = np.searchsorted(batch.offs, a, "right") - 1
    return {"doc": doc, "a": a, "core": grams[a], "lo": a - start[tail], "hi": a - start[head]}


def _valid(batch: Batch, c: dict) -> tuple[np.ndarray, np.ndarray]:
    """The distances whose windows lie within the text."""
    first, end = batch.offs[c["doc"]], batch.offs[c["doc"] + 1]
    return np.maximum(c["a"] + WINDOW - end, 0), np.minimum(c["a"] - first, RUN - 1)


def _span(sums: np.ndarray, at: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Fingerprint of all that the windows at distances near..far cover."""
    shape = (near * (RUN + 1) + far).astype(U64)
    return mix(SPAN.slices(sums, at - far, at - near + WINDOW) ^ mix(shape + U64(7)))


def _ranks(docs: DataFrame) -> DataFrame:
    """`core, txt, twice`: first ranks, once per text and batch."""
    def emit(b):
        for _, _, batch in text_batches(b.column("text")):
            c = chosen(batch)
            if c is None:
                continue
            order = np.lexsort((c["core"], c["doc"]))
            core, doc = c["core"][order], c["doc"][order]
            fresh = np.ones(len(core), bool)
            fresh[1:] = (core[1:] != core[:-1]) | (doc[1:] != doc[:-1])
            count = np.diff(np.concatenate((np.flatnonzero(fresh), [len(core)])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(core[fresh])), pa.array(signed(text_keys(batch)[doc[fresh]])), pa.array(count > 1)],
                ["core", "txt", "twice"])

    return arrow_apply(docs.select("text"), emit, "core long, txt long, twice boolean")


def _runs(docs: DataFrame, repeated) -> DataFrame:
    """The runs whose first rank repeats: `core, span, txt, a, lo, hi`."""
    def emit(b):
        for _, _, batch in text_batches(b.column("text")):
            c = chosen(batch)
            if c is None:
                continue
            keep = np.flatnonzero(repeated.value.has(c["core"]))
            if not len(keep):
                continue
            c = {k: v[keep] for k, v in c.items()}
            near, far = _valid(batch, c)
            span = _span(SPAN.sums(batch.data), c["a"], near, far)
            txt = text_keys(batch)[c["doc"]]
            at = c["a"] - batch.offs[c["doc"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(c["core"])), pa.array(signed(span)), pa.array(signed(txt)), pa.array(at.astype(np.int32)),
                 pa.array(c["lo"].astype(np.int32)), pa.array(c["hi"].astype(np.int32))],
                ["core", "span", "txt", "a", "lo", "hi"])

    rows = arrow_apply(docs.select("text"), emit, "core long, span long, txt long, a int, lo int, hi int")
    return saved(rows.distinct(), "suffix-runs")


def _contexts(docs: DataFrame, wanted) -> DataFrame:
    """`key, before, near, far, bytes` around the wanted positions."""
    def emit(b):
        for _, _, batch in text_batches(b.column("text")):
            c = chosen(batch)
            if c is None:
                continue
            txt = text_keys(batch)[c["doc"]]
            key = position_keys(txt, c["a"] - batch.offs[c["doc"]])
            keep = np.flatnonzero(wanted.value.has(key))
            if not len(keep):
                continue
            c = {k: v[keep] for k, v in c.items()}
            near, far = _valid(batch, c)
            left = c["a"] - far
            right = c["a"] - near + WINDOW
            raw = batch.data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(key[keep])), pa.array(far.astype(np.int32)), pa.array(near.astype(np.int32)),
                 pa.array(far.astype(np.int32)), pa.array([raw[x:y] for x, y in zip(left, right)], pa.binary())],
                ["key", "before", "near", "far", "bytes"])

    rows = arrow_apply(docs.select("text"), emit, "key long, before int, near int, far int, bytes binary")
    return saved(rows.dropDuplicates(["key"]), "suffix-contexts")


def _cut(todo: DataFrame, step: int, level: int) -> DataFrame:
    """The runs of `todo` cut into runs of `step` starts, with their ranks."""
    def emit(b):
        raw = b.column("bytes")
        sizes = np.fromiter((len(x.as_buffer()) for x in raw), np.int64, len(raw))
        offs = np.concatenate(([0], np.cumsum(sizes)))
        data = np.frombuffer(b"".join(x.as_py() for x in raw), np.uint8)
        num = lambda c: b.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
        at = offs[:-1] + num("before")
        x0, x1, lo, hi, near, far = (num(c) for c in ("x", "y", "lo", "hi", "near", "far"))
        cores, spans = CORE.sums(data), SPAN.sums(data)
        for k in range(0, int((x1 - x0).max()) + 1, step):
            x = x0 + k
            y = np.minimum(x + step - 1, x1)
            keep = np.flatnonzero((x <= x1) & (np.maximum(x, np.maximum(lo, near)) <= np.minimum(y, np.minimum(hi, far))))
            if not len(keep):
                continue
            x, y, p = x[keep], y[keep], at[keep]
            tag = mix(x.astype(U64) + U64(1000 * (level + 1)))
            core = mix(CORE.slices(cores, p - x, p - y + WINDOW) ^ tag)
            span = _span(spans, p, np.maximum(x, near[keep]), np.minimum(y, far[keep]))
            cols = [b.column(c).take(pa.array(keep)) for c in ("txt", "a", "lo", "hi", "many")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(core)), pa.array(signed(span)), *cols, pa.array(x.astype(np.int32)), pa.array(y.astype(np.int32))],
                ["core", "span", "txt", "a", "lo", "hi", "many", "x", "y"])

    return arrow_apply(todo, emit, "core long, span long, txt long, a int, lo int, hi int, many boolean, x int, y int")


def _rerank(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(runs that repeat as a whole, runs to cut further).

    `many` marks a representative of equal spans that are settled already."""
    one = (runs.groupBy("core", "span").agg(
        F.count("*").alias("k"), F.max("many").alias("old"), F.min(F.struct("txt", "a")).alias("r"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("x").alias("x"), F.max("y").alias("y"))
        .withColumn("many", F.col("old") | (F.col("k") > 1)))
    one = saved(one, "suffix-classes")
    done = (runs.where(~F.col("many")).join(one.where("many").select("core", "span"), ["core", "span"], "left_semi")
            .select("txt", (F.col("a") - F.least("hi", "y")).alias("first"), (F.col("a") - F.greatest("lo", "x")).alias("last")))
    cores = saved(one.groupBy("core").agg(F.count("*").alias("spans"), F.min("many").alias("settled"))
                  .where("spans > 1 and not settled").select("core"), "suffix-cores")
    todo = one.join(cores, "core", "left_semi").select(
        F.xxhash64("r.txt", F.col("r.a").cast("long")).alias("key"), "r.txt", "r.a", "lo", "hi", "many", "x", "y")
    return saved(done, "suffix-repeats"), saved(todo, "suffix-open")


def repeated_ranges(docs: DataFrame) -> list[DataFrame]:
    """Tables `txt, first, last`: starts first..last of the text `txt` have a
    WINDOW-byte string that occurs elsewhere."""
    ranks = _ranks(docs).groupBy("core").agg(F.min("txt").alias("lo"), F.max("txt").alias("hi"), F.max("twice").alias("t"))
    repeated = hash_bitmap(ranks.where("lo < hi or t"), "core")
    runs = _runs(docs, repeated).withColumns({"many": F.lit(False), "x": F.lit(0), "y": F.lit(RUN - 1)})
    done, todo = _rerank(runs)
    found = [done]
    around = _contexts(docs, hash_bitmap(todo, "key"))
    for level, step in enumerate(STEPS):
        runs = saved(_cut(todo.join(around, "key"), step, level), "suffix-runs")
        done, todo = _rerank(runs)
        found.append(done)
    return found


def _keyed(docs: DataFrame) -> DataFrame:
    """`docs` with `txt`, the key of its text."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def emit(b):
        for lo, hi, batch in text_batches(b.column("text")):
            part = b.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(signed(text_keys(batch)))],
                                             [*part.schema.names, "txt"])

    return arrow_apply(docs, emit, f"{fields}, txt long")


def _spans_of(docs: DataFrame) -> DataFrame:
    """`k, copies, ranges` per text: how often it occurs, and its repeats."""
    found = repeated_ranges(docs)
    ranges = found[0]
    for f in found[1:]:
        ranges = ranges.unionByName(f)
    per_text = ranges.distinct().groupBy("txt").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    copies = _keyed(docs.select("text")).groupBy("txt").agg(F.count("*").alias("copies")).where("copies > 1")
    both = copies.join(per_text, "txt", "full_outer").select(F.col("txt").alias("k"), "copies", "ranges")
    return saved(both, "suffix-found")


def covered(size: int, copies, ranges) -> list[tuple[int, int]]:
    """Maximal removed byte runs of a text."""
    if size >= WINDOW and (copies or 0) > 1:
        return [(0, size)]
    out: list = []
    for first, last in sorted((r["first"], r["last"]) for r in ranges or ()):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last + WINDOW))
        else:
            out.append((first, last + WINDOW))
    return out


def _without(raw: bytes, spans: list) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    out.append(raw[at:])
    return b"".join(out)


def dedup_rows(docs: DataFrame) -> DataFrame:
    """Query form: `doc_id, n_bytes, n_removed, n_spans, kept_sha256`."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def emit(b):
        ids, texts = b.column("doc_id"), b.column("text").to_pylist()
        out: list = [[], [], [], []]
        for t, c, r in zip(texts, b.column("copies").to_pylist(), b.column("ranges").to_pylist()):
            raw = (t or "").encode()
            spans = covered(len(raw), c, r)
            for col, v in zip(out, (len(raw), sum(y - x for x, y in spans), len(spans),
                                    hashlib.sha256(_without(raw, spans)).hexdigest())):
                col.append(v)
        yield pa.RecordBatch.from_arrays(
            [ids, *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = _spans_of(docs)
    rows = _keyed(docs.select("doc_id", "text"))
    joined = rows.join(found, F.col("txt") == F.col("k"), "left").select("doc_id", "text", "copies", "ranges")
    return arrow_apply(joined, emit, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Filter form: `docs` with the repeated bytes cut out of `text` (bytes of a
    character that is cut in two are dropped); all documents stay."""
    names = [f"own_{i}" for i in range(len(docs.columns))]
    own = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names)], "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])
    found = _spans_of(docs)
    joined = _keyed(own).join(found, F.col("txt") == F.col("k"), "left").select(*names, "text", "copies", "ranges")

    def emit(b):
        texts = []
        for t, c, r in zip(b.column("text").to_pylist(), b.column("copies").to_pylist(), b.column("ranges").to_pylist()):
            raw = (t or "").encode()
            spans = covered(len(raw), c, r)
            texts.append(_without(raw, spans).decode("utf-8", "ignore") if spans else t)
        yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(texts, pa.string())], [*names, "_cut"])

    out = arrow_apply(joined, emit, f"{fields}, _cut string")
    return out.select(*[F.col("_cut" if c == "text" else n).alias(c) for c, n in zip(docs.columns, names)])
