"""Removal of repeated phrases with sharded Aho-Corasick automata.

A window is WINDOW consecutive words.  A word goes when a window covers it whose
words also start in a document with a smaller doc_id.

1. Every window chooses, of its SEED-word phrases, the one with the smallest
   hash; equal windows choose the same.  Seeds that occur in one word sequence
   only cannot recur and are dropped with their windows (first by a fixed-size
   bitmap, later exactly).
2. The windows that share a seed form a passage of WINDOW to WINDOW + RUN - 1
   words.  Passages of recurring seeds from all documents are taken once for each
   text, with its smallest and largest doc_id.  They give the windows with theirs,
   grouped by seed and digest and not by text; those with two different ones are
   the confirmed phrases.
3. Confirmed phrases are dealt to shards by their seed, about SHARD_PHRASES to a
   shard, and each shard is compiled into automata over word numbers, one for the
   seeds of about AUTOMATON_PASSAGES passages, in which windows that follow each other
   and have one first document are one entry.  All passages that can lose a word, each
   text once, are streamed through the automaton of their seed, which locates every
   phrase.  A shard with many passages is read by several tasks, each with its own
   copy of the automata.  Where a seed has more than SHARD_PHRASES
   phrases, its passages are cut into their windows, and windows and phrases are
   dealt by the hash of seed and words, so no seed is bound to one shard.
4. What is located in a text goes to every place where the text stands.

Equal word sequences lose words as their smallest doc_id does; the other copies
are removed as a whole when they hold a window.

Defined results: words are `[^\\x20\\x09-\\x0D]+`, unchanged; null text has no
words; a null doc_id is not smaller than any and loses nothing; rows that share a
doc_id do not remove each other's words; documents of under WINDOW words keep
all; an empty table gives an empty table; only doc_id and text are read; long texts
are read whole.  Word sequences are equal when 64 bits of a cryptographic digest are,
seeds when their 64-bit hashes are, phrases when seed and
64 bits of a cryptographic digest are.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import (U64, Batch, Rolling, arrow_apply, digests, hash_bitmap, saved, signed, text_batches,
                                  windows_of)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
SEED = 5
RUN = WINDOW - SEED + 1
SHARD_PHRASES = 50_000
TASK_PASSAGES = 50_000
AUTOMATON_PASSAGES = 512  # the library looks through all children of a node, so wide roots are slow

SEQUENCE = Rolling(41)


class Words:
    """Word bounds, text index and sequence keys of a batch."""

    def __init__(self, batch: Batch):
        self.batch = batch
        self.start, self.end, self.doc = batch.words()
        self.hashes = batch.word_hashes(self.start, self.end)
        self.sums = SEQUENCE.sums(self.hashes)
        self.count = np.bincount(self.doc, minlength=batch.n)
        self.first = np.concatenate(([0], np.cumsum(self.count)))

    def keys(self) -> np.ndarray:
        return digests(self.hashes, self.first[:-1], self.first[1:])

    def chosen(self) -> dict | None:
        """Seeds of all windows: `seed`, `doc`, and the words from..to (behind
        the last) that its windows cover."""
        starts = windows_of(self.doc, WINDOW)
        if not len(starts):
            return None
        n = len(self.doc)
        i = np.arange(n - SEED + 1)
        grams = SEQUENCE.slices(self.sums, i, i + SEED)
        low = U64((1 << max(22, int(n).bit_length())) - 1)
        key = (grams & ~low) | i.astype(U64)
        least = key[: len(key) - RUN + 1].copy()
        for k in range(1, RUN):
            np.minimum(least, key[k: len(key) - RUN + 1 + k], out=least)
        at = (least[starts] & low).astype(np.int64)
        head = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
        tail = np.concatenate((head[1:] - 1, [len(at) - 1]))
        return {"seed": grams[at[head]], "doc": self.doc[at[head]], "from": starts[head], "to": starts[tail] + WINDOW}


def _seeds(docs: DataFrame) -> DataFrame:
    def emit(b):
        for _, _, batch in text_batches(b.column("text")):
            w = Words(batch)
            c = w.chosen()
            if c is None:
                continue
            yield pa.RecordBatch.from_arrays([pa.array(signed(c["seed"])), pa.array(signed(w.keys()[c["doc"]]))],
                                             ["seed", "seq"])

    return arrow_apply(docs.select("text"), emit, "seed long, seq long")


def _passages(docs: DataFrame, recurring) -> DataFrame:
    """`seed, text, passage, seq, at, doc_id` of the recurring seeds: `text` is the
    passage's key, `at` its first word."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def emit(b):
        for lo, hi, batch in text_batches(b.column("text")):
            w = Words(batch)
            c = w.chosen()
            if c is None:
                continue
            keep = np.flatnonzero(recurring.value.has(c["seed"]))
            if not len(keep):
                continue
            raw = batch.data.tobytes()
            s, e = w.start.tolist(), w.end.tolist()
            text = [b" ".join([raw[s[i]:e[i]] for i in range(x, y)])
                    for x, y in zip(c["from"][keep].tolist(), c["to"][keep].tolist())]
            doc = c["doc"][keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(c["seed"][keep])), pa.array(keys_of(text)), pa.array(text, pa.binary()).cast(pa.string()),
                 pa.array(signed(w.keys()[doc])), pa.array((c["from"][keep] - w.first[doc]).astype(np.int32)),
                 b.column("doc_id").slice(lo, hi - lo).take(pa.array(doc))],
                ["seed", "text", "passage", "seq", "at", "doc_id"])

    return saved(arrow_apply(docs.select("doc_id", "text"), emit,
                             f"seed long, text long, passage string, seq long, at int, doc_id {kind}"), "phrase-passages")


def _texts(passages: DataFrame) -> DataFrame:
    """`seed, passage, text, lo, hi`: every passage text once, with its key and its
    smallest and largest doc_id."""
    return passages.groupBy("seed", "passage").agg(F.min("text").alias("text"), F.min("doc_id").alias("lo"),
                                                   F.max("doc_id").alias("hi"))


def keys_of(texts: list) -> np.ndarray:
    """`window_key` of many byte strings."""
    raw = b"".join([hashlib.md5(t, usedforsecurity=False).digest() for t in texts])
    return np.frombuffer(raw, ">i8")[::2].astype(np.int64)


def window_key(words: bytes) -> int:
    """64 bits of the MD5 of a window's words, as `_key_of` computes them in columns."""
    return int.from_bytes(hashlib.md5(words, usedforsecurity=False).digest()[:8], "big", signed=True)


def _key_of(words: Column) -> Column:
    return F.conv(F.substring(F.md5(words.cast("binary")), 1, 16), 16, -10).cast("long")


def windows_cut(words: list) -> list:
    """The windows of a passage's words, as bytes."""
    return [b" ".join(words[k:k + WINDOW]) for k in range(len(words) - WINDOW + 1)]


def window_keys(passage: bytes) -> list:
    """`window_key` of every window of a passage."""
    return keys_of(windows_cut(passage.split(b" "))).tolist()


def _phrases(texts: DataFrame) -> DataFrame:
    """`seed, phrase, first`: windows found in documents with different doc_id, by
    their keys; no text is shuffled."""
    kind = texts.schema["lo"].dataType.simpleString()

    def emit(b):
        cut = [windows_cut(p.split(b" ")) for p in b.column("passage").cast(pa.binary()).to_pylist()]
        at = pa.array(np.repeat(np.arange(len(cut)), [len(c) for c in cut]))
        keys = pa.array(keys_of([w for c in cut for w in c]))
        yield pa.RecordBatch.from_arrays([b.column("seed").take(at), keys, b.column("lo").take(at), b.column("hi").take(at)],
                                         ["seed", "phrase", "lo", "hi"])

    rows = arrow_apply(texts, emit, f"seed long, phrase long, lo {kind}, hi {kind}")
    found = rows.groupBy("seed", "phrase").agg(F.min("lo").alias("first"), F.max("hi").alias("last"))
    return saved(found.where("first < last").select("seed", "phrase", "first"), "phrase-confirmed")


def _runs(firsts: list) -> list:
    """(first window, window after the last, first document) of the windows that
    follow each other, are confirmed and have one first document."""
    if firsts.count(firsts[0]) == len(firsts):
        return [] if firsts[0] is None else [(0, len(firsts), firsts[0])]
    out, start = [], 0
    for k in range(1, len(firsts) + 1):
        if k == len(firsts) or firsts[k] != firsts[start]:
            if firsts[start] is not None:
                out.append((start, k, firsts[start]))
            start = k
    return out


def locate(passages: pa.Table, phrases: pa.Table) -> pa.Table:
    """Runs of windows of `passages` found by the automaton of `phrases` whose first
    document is smaller than `doc_id`: `seed, seq, word, stop` (the word behind the
    run's last window start), `first`.  An automaton reads numbers of words; the words
    of a phrase are taken from the passages that lose it."""
    import ahocorasick

    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), phrases.schema.field("first").type]
    names = ["seed", "seq", "word", "stop", "first"]
    out: list = [[] for _ in names]
    if not passages.num_rows or not phrases.num_rows:
        return pa.table([pa.array(v, k) for v, k in zip(out, kinds)], names)
    # equal windows have one seed: passages without a phrase of their seed hold none
    passages = passages.filter(pc.is_in(passages["seed"], value_set=phrases["seed"].combine_chunks())).sort_by("seed")
    seeds, seqs, places = [passages[c].to_pylist() for c in ("seed", "seq", "at")]
    known = dict(zip(zip(phrases["seed"].to_pylist(), phrases["phrase"].to_pylist()), phrases["first"].to_pylist()))
    split = [raw.split(b" ") for raw in passages["passage"].cast(pa.binary()).to_pylist()]
    cut = [windows_cut(words) for words in split]
    windows = zip([s for s, c in zip(seeds, cut) for _ in c], keys_of([w for c in cut for w in c]).tolist())
    firsts = list(map(known.get, windows))

    def search(read: list):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        numbers: dict = {}
        texts = []
        for i, doc_id, runs in read:
            texts.append(tuple([numbers.setdefault(w, len(numbers)) for w in split[i]]))
            for s, e, first in runs:
                automaton.add_word(texts[-1][s:e + WINDOW - 1], (first, e - s))
        automaton.make_automaton()
        for (i, doc_id, _), text in zip(read, texts):
            for end, (first, n) in automaton.iter(text):
                if first < doc_id:
                    stop = places[i] + end + 2 - WINDOW
                    for col, v in zip(out, (seeds[i], seqs[i], stop - n, stop, first)):
                        col.append(v)

    read, at = [], 0
    for i, (c, doc_id) in enumerate(zip(cut, passages["doc_id"].to_pylist())):
        runs = [] if doc_id is None else [r for r in _runs(firsts[at:at + len(c)]) if r[2] < doc_id]
        at += len(c)
        if runs:  # a passage that loses nothing need not be read, and its phrases are in those that do
            if len(read) >= AUTOMATON_PASSAGES and seeds[i] != seeds[read[-1][0]]:
                search(read)
                read = []
            read.append((i, doc_id, runs))
    if read:
        search(read)
    return pa.table([pa.array(v, k) for v, k in zip(out, kinds)], names)


def _dealt(passages: DataFrame, phrases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Passages and phrases with the `shard` and `part` of their automaton."""
    shards = max(1, -(-phrases.count() // SHARD_PHRASES))
    # a row for every SHARD_PHRASES phrases at most
    hot = F.broadcast(saved(phrases.groupBy("seed").agg(F.count("*").alias("n")).where(F.col("n") > SHARD_PHRASES)
                            .select("seed", F.lit(True).alias("hot")), "phrase-hot-seeds"))
    split = F.coalesce(F.col("hot"), F.lit(False))
    shard = lambda key: F.pmod(F.when(split, F.xxhash64("seed", key)).otherwise(F.col("seed")), F.lit(shards)).cast("int")
    words = F.split("passage", " ")
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda k: F.struct(
        F.array_join(F.slice(words, k + 1, WINDOW), " ").alias("passage"), (F.col("at") + k).cast("int").alias("at")))
    pieces = F.when(split, windows).otherwise(F.array(F.struct("passage", "at")))
    dealt = (passages.join(hot, "seed", "left").select("seed", "hot", "seq", "doc_id", F.explode(pieces).alias("piece"))
             .select("seed", "hot", "piece.passage", "seq", "piece.at", "doc_id")
             .withColumn("shard", shard(_key_of(F.col("passage")))))
    parts = saved(dealt.groupBy("shard").agg((F.floor((F.count("*") - 1) / TASK_PASSAGES) + 1).cast("int").alias("parts")),
                  "phrase-shards")
    copies = (phrases.join(hot, "seed", "left").withColumn("shard", shard(F.col("phrase"))).join(parts, "shard")
              .select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "seed", "phrase", "first"))
    spread = dealt.join(parts, "shard").withColumn(
        "part", F.pmod(F.xxhash64("seq", "at"), F.col("parts")).cast("int")).select(
        "shard", "part", "seed", "passage", "seq", "at", "doc_id")
    return spread, copies


def _located(passages: DataFrame, phrases: DataFrame) -> DataFrame:
    """`seed, seq, word, stop, first`: runs of windows found by sharded automata."""
    kind = phrases.schema["first"].dataType.simpleString()
    spread, copies = _dealt(passages, phrases)
    return (spread.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part"))
            .applyInArrow(locate, f"seed long, seq long, word int, stop int, first {kind}"))


def _occurrences(passages: DataFrame, phrases: DataFrame) -> DataFrame:
    """`seq, word`: first words of the windows that go."""
    each = F.sequence(F.col("word").cast("long"), F.col("stop").cast("long") - 1)
    return _located(passages, phrases).select("seq", F.explode(each).alias("word"))


def _gone(docs: DataFrame, recurring) -> DataFrame:
    """`seq, starts`: runs of windows that go, per word sequence."""
    passages = _passages(docs, recurring)
    texts = saved(_texts(passages), "phrase-texts")
    once = texts.select("seed", "passage", F.col("text").alias("seq"), F.lit(0).alias("at"), F.col("hi").alias("doc_id"))
    runs = saved(_located(once, _phrases(texts)).withColumnRenamed("seq", "text"), "phrase-located")
    placed = (passages.select("seed", "text", "seq", "at", "doc_id").join(runs, ["seed", "text"])
              .select("seq", "doc_id", F.struct((F.col("at") + F.col("word")).alias("word"),
                                                (F.col("at") + F.col("stop")).alias("stop"), "first").alias("run")))
    # every copy of a sequence gives the same runs, so the smallest doc_id is among them
    held = placed.groupBy("seq").agg(F.min("doc_id").alias("least"), F.collect_set("run").alias("runs"))
    return held.select("seq", F.transform(F.filter("runs", lambda r: r["first"] < F.col("least")),
                                          lambda r: F.struct(r["word"].alias("word"), r["stop"].alias("stop"))).alias("starts"))


def _found(docs: DataFrame) -> DataFrame:
    """`k, first, starts` per word sequence: its smallest doc_id and the windows
    that go."""
    seen = _seeds(docs).groupBy("seed").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    recurring = hash_bitmap(seen.where("lo < hi"), "seed")
    starts = _gone(docs, recurring).where(F.size("starts") > 0)
    firsts = _keyed(docs.select("doc_id", "text")).groupBy("seq").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    both = firsts.where("n > 1").join(starts, "seq", "full_outer")
    return saved(both.select(F.col("seq").alias("k"), "first", "starts"), "phrase-found")


def _keyed(docs: DataFrame) -> DataFrame:
    """`docs` with `seq`, the key of its word sequence."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def emit(b):
        for lo, hi, batch in text_batches(b.column("text")):
            part = b.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(signed(Words(batch).keys()))],
                                             [*part.schema.names, "seq"])

    return arrow_apply(docs, emit, f"{fields}, seq long")


def kept_words(words: list, doc_id, first, starts) -> list:
    if doc_id is None or len(words) < WINDOW:
        return words
    if first is not None and first < doc_id:
        return []
    if not starts:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for r in starts:
        gone[r["word"]] += 1
        gone[r["stop"] + WINDOW - 1] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return [w for w, k in zip(words, keep) if k]


def dedup_rows(docs: DataFrame) -> DataFrame:
    """Query form: `doc_id, n_words, n_removed, kept_sha256`."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def emit(b):
        ids = b.column("doc_id")
        out: list = [[], [], []]
        for i, t, first, starts in zip(ids.to_pylist(), b.column("text").cast(pa.binary()).to_pylist(),
                                       b.column("first").to_pylist(), b.column("starts").to_pylist()):
            words = (t or b"").split()  # at [\x20\x09-\x0D], as these are bytes
            kept = kept_words(words, i, first, starts)
            for col, v in zip(out, (len(words), len(words) - len(kept),
                                    hashlib.sha256(b" ".join(kept)).hexdigest())):
                col.append(v)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"])

    found = _found(docs)
    joined = (_keyed(docs.select("doc_id", "text")).join(found, F.col("seq") == F.col("k"), "left")
              .select("doc_id", "text", "first", "starts"))
    return arrow_apply(joined, emit, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
