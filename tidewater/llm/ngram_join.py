"""N-gram Jaccard self-join with prefix filters under several global token orders.

A document is its set of distinct 5-word shingles (as 64-bit hashes).  Under any
order of all shingles, two sets with Jaccard >= 0.8 share many of the first
n - ceil(0.8 n) + 1 shingles of each: how many at least follows from the sizes.
Candidates must pass that test under every one of ORDERS before they are
verified on the whole sets.  All orders put shingles that very many documents
share last (a fixed-size count sketch over all documents tells which); otherwise
they are unrelated hashes.  Any such order is valid, so the sketch decides the
work and never the result.

Copies and hot groups: equal word sequences form one class, which takes part
once.  Classes first link to leaders of their token groups, and then, while many pairs
of different components share a shingle early in their order, to a few head classes of
such shingles; components of these links are taken as known, and only classes
of different components are compared pair by pair.  That join asks for FEW shingles
shared so early in both sets that linking pairs must have them, so classes that share no
more than a frequent line never meet.  A large group of near copies costs some
comparisons per member, and no link between different texts is lost.

Defined results: words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; a text of
one to four words is one shingle; null text or a text without words has no
shingles and links with nothing (its component is its own doc_id); the component
of a group is its smallest doc_id that is not null; repeated rows are copies; an
empty table gives an empty table; other columns are not read; long texts are read
whole.  Equality of shingles is that of 64-bit hashes, equality of word sequences that
of 64 bits of a cryptographic digest.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import (U64, Batch, Rolling, arrow_apply, digests, dropped, hash_bitmap, mix, saved,
                                  shuffles_freed, signed, text_batches, windows_of)
from tidewater.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
PERCENT = 80  # Jaccard threshold in hundredths
ORDERS = (0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x2545F4914F6CDD1D)
CELL_BITS = 20   # cells of the count sketch: 2**20, at any input size
CHUNK_CELLS = 1 << 14
LEADERS = 4  # whose shared shingles a class counts
FEW = 2      # early shingles that pairs of different components are asked to share
CROWD = 8    # pairs for each class from which on a shingle is crowded
HEADS = 8    # classes of a crowded shingle that its other classes meet
SET_BYTES = 1 << 18  # text bytes handled by one numpy pass

SHINGLE_HASH = Rolling(23)


def by_text(h: np.ndarray, d: np.ndarray, texts: int) -> np.ndarray:
    """Order by text index, then hash; small indices are sorted by their digits."""
    order = np.argsort(h)
    small = d[order].astype(np.uint16 if texts <= 1 << 16 else np.int64)
    return order[np.argsort(small, kind="stable")]


def shingle_sets(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, shingle hash) sorted without repeats, then per text the
    number of shingles and the hash of its word sequence."""
    low = batch.lowered()
    start, end, doc = low.words()
    words = low.word_hashes(start, end)
    sums = SHINGLE_HASH.sums(words)
    n_words = np.bincount(doc, minlength=low.n)
    first = np.concatenate(([0], np.cumsum(n_words)))
    whole = digests(words, first[:-1], first[1:])
    at = windows_of(doc, WORDS)
    short = np.flatnonzero((n_words > 0) & (n_words < WORDS))
    h = np.concatenate((SHINGLE_HASH.slices(sums, at, at + WORDS), whole[short]))
    d = np.concatenate((doc[at], short))
    order = by_text(h, d, low.n)
    h, d = h[order], d[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[fresh], d[fresh]
    return d, h, np.bincount(d, minlength=low.n), mix(whole)


def prefix_size(n: np.ndarray) -> np.ndarray:
    return n - (PERCENT * n + 99) // 100 + 1


def ranks(d: np.ndarray, h: np.ndarray, n: np.ndarray, late: np.ndarray, seed: int) -> np.ndarray:
    """Place from 0 of every (text, shingle) row in its text under one order: `late`
    (0 for most shingles, more for frequent ones) first, then a hash."""
    key = (late.astype(U64) << U64(58)) | (mix(h ^ U64(seed)) >> U64(6))
    order = by_text(key, d, len(n))
    first = np.concatenate(([0], np.cumsum(n)))
    out = np.zeros(len(d), np.int64)
    out[order] = np.arange(len(d)) - first[d[order]]
    return out


def prefixes(d: np.ndarray, h: np.ndarray, n: np.ndarray, late: np.ndarray, seed: int) -> np.ndarray:
    """Which (text, shingle) rows are in the prefix under one order."""
    return ranks(d, h, n, late, seed) < prefix_size(n)[d]


class Sketch:
    """Counts of shingles by cell; a shingle is late when its cell holds clearly
    more than an even share."""

    def __init__(self, cells: np.ndarray):
        mean = cells.mean() if len(cells) else 0.0
        limit = mean + 5 * np.sqrt(mean) + 32
        self.level = np.where(cells > limit, np.clip(np.log2(np.maximum(cells / limit, 1)).astype(np.int64) + 1, 1, 60),
                              0).astype(np.uint8)

    def late(self, h: np.ndarray) -> np.ndarray:
        return self.level[(h >> U64(64 - CELL_BITS)).astype(np.int64)]


def _survey(docs: DataFrame) -> DataFrame:
    """Members and sketch pieces, in one pass."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        cells = np.zeros(1 << CELL_BITS, np.uint32)
        id_type = None
        for b in batches:
            id_type = b.schema.field("doc_id").type
            text = b.column("text")
            for lo, hi, batch in text_batches(text, SET_BYTES):
                d, h, n, cls = shingle_sets(batch)
                np.add.at(cells, (h >> U64(64 - CELL_BITS)).astype(np.int64), 1)
                size = hi - lo
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, size), pa.array(signed(cls), pa.int64(), mask=n == 0),
                     pa.array(n, pa.int64()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary())], names)
        if id_type is not None:
            part = cells.reshape(-1, CHUNK_CELLS)
            used = [i for i in range(len(part)) if part[i].any()]
            if used:
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(used), id_type), pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.int64()),
                     pa.array(used, pa.int32()), pa.array([part[i].tobytes() for i in used], pa.binary())], names)

    names = ["doc_id", "cls", "n_shingles", "chunk", "cells"]
    return saved(docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, cls long, n_shingles long, chunk int, cells binary"), "ngram-survey")


def _members(survey: DataFrame) -> DataFrame:
    return survey.where("chunk is null").select("doc_id", "cls", "n_shingles")


def _sketch(survey: DataFrame):
    """Broadcast of the summed sketch: 2**CELL_BITS cells, whatever the input."""
    def add(batches):
        sums: dict = {}
        for b in batches:
            for c, x in zip(b.column("chunk").to_pylist(), b.column("cells").to_pylist()):
                have = sums.setdefault(c, np.zeros(CHUNK_CELLS, np.int64))
                have += np.frombuffer(x, np.uint32)
        if sums:
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(sums), pa.int32()),
                                              "cells": pa.array([v.tobytes() for v in sums.values()], pa.binary())})

    cells = np.zeros(1 << CELL_BITS, np.int64)
    spark = survey.sparkSession
    with shuffles_freed(spark):
        pieces = survey.where("chunk is not null").select("chunk", "cells").repartition("chunk")
        sums = pieces.mapInArrow(add, "chunk int, cells binary").collect()
    for r in sums:
        cells[r["chunk"] * CHUNK_CELLS:(r["chunk"] + 1) * CHUNK_CELLS] = np.frombuffer(r["cells"], np.int64)
    return spark.sparkContext.broadcast(Sketch(cells))


def _tokens(docs: DataFrame, sketch, shared=None) -> DataFrame:
    """Prefix shingles under the first order and their places (token, cls, n, at);
    with the bitmap `shared` only those in it."""
    def emit(b):
        for _, _, batch in text_batches(b.column("text"), SET_BYTES):
            d, h, n, cls = shingle_sets(batch)
            at = ranks(d, h, n, sketch.value.late(h), ORDERS[0])
            keep = at < prefix_size(n)[d]
            if shared is not None:
                keep &= shared.value.has(mix(h))
            d, h = d[keep], h[keep]
            yield pa.RecordBatch.from_arrays([pa.array(signed(mix(h))), pa.array(signed(cls[d])), pa.array(n[d]),
                                              pa.array(at[keep].astype(np.int32))], ["token", "cls", "n", "at"])

    return arrow_apply(docs.select("text"), emit, "token long, cls long, n long, at int")


def _sets(docs: DataFrame, sketch, wanted, had=None) -> DataFrame:
    """`cls, n, p1, p2 (prefixes under the later orders), all` of the classes in
    the bitmap `wanted` and not in `had`; copies collapse before they are shuffled."""
    def emit(b):
        for _, _, batch in text_batches(b.column("text"), SET_BYTES):
            d, h, n, cls = shingle_sets(batch)
            docs_in = wanted.value.has(cls) & (n > 0)
            if had is not None:
                docs_in &= ~had.value.has(cls)
            first_of = np.zeros(len(cls), bool)
            first_of[np.unique(cls, return_index=True)[1]] = True
            docs_in &= first_of
            keep = docs_in[d]
            d, h = d[keep], h[keep]
            left = np.where(docs_in, n, 0)
            late = sketch.value.late(h)
            ends = np.concatenate(([0], np.cumsum(left[docs_in]))).astype(np.int32)
            cols = [pa.array(signed(cls[docs_in])), pa.array(n[docs_in])]
            for seed in ORDERS[1:]:
                p = prefixes(d, h, left, late, seed)
                size = np.bincount(d[p], minlength=len(n))[docs_in]
                cols.append(pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(signed(h[p]))))
            cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(h))))
            yield pa.RecordBatch.from_arrays(cols, ["cls", "n", *[f"p{i}" for i in range(1, len(ORDERS))], "whole"])

    lists = ", ".join(f"p{i} array<long>" for i in range(1, len(ORDERS)))
    rows = arrow_apply(docs.select("text"), emit, f"cls long, n long, {lists}, whole array<long>")
    return saved(rows.dropDuplicates(["cls"]), "ngram-sets")


def _need(na: Column, nb: Column) -> Column:
    return F.ceil((na + nb) * F.lit(PERCENT) / F.lit(100 + PERCENT))


def least_shared(na: Column, nb: Column) -> Column:
    """How many prefix shingles two sets share at least when they link: of the
    needed overlap, what lies behind the shorter prefix is taken off."""
    need = _need(na, nb)
    behind = lambda n: F.ceil(n * F.lit(PERCENT) / F.lit(100)) - 1
    return F.greatest(F.least(need - behind(na), need - behind(nb)), F.lit(1))


def _early(na: Column, at_a: Column, nb: Column, at_b: Column) -> tuple[Column, Column]:
    """Whether a shared shingle lies so early in both sets that a linking pair shares
    `few` of that kind: the first n - need + few places of two sets hold that many."""
    few = F.least(least_shared(na, nb), F.lit(FEW))
    return F.least(na - at_a, nb - at_b) + few > _need(na, nb), few


def _sizes_fit(na: Column, nb: Column) -> Column:
    return 100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)


def _ends(pairs: DataFrame):
    return hash_bitmap(pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))), "cls")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the candidates `a, b` (first order passed), those that pass the other
    orders and then the exact test."""
    side = lambda s: sets.select(*[F.col(c).alias(f"{c}_{s}") for c in sets.columns])
    both = (pairs.join(side("a"), F.col("a") == F.col("cls_a")).join(side("b"), F.col("b") == F.col("cls_b")))
    na, nb = F.col("n_a"), F.col("n_b")
    for i in range(1, len(ORDERS)):
        both = both.where(F.size(F.array_intersect(f"p{i}_a", f"p{i}_b")) >= least_shared(na, nb))
    same = F.size(F.array_intersect("whole_a", "whole_b"))
    return both.where(100 * same >= PERCENT * (na + nb - same)).select("a", "b")


def _led(postings: DataFrame) -> DataFrame:
    """Candidates `a, b`: every token has a leader, the same one for many tokens.  Of
    those that lead most tokens of a class, it is paired with the two that share most
    of all its prefix, so that the leaders of one group are linked as well."""
    drawn = F.xxhash64("cls", F.pmod("token", F.lit(LEADERS)))
    first = F.min(F.struct(drawn.alias("h"), "cls", "n")).alias("l")
    leaders = saved(postings.groupBy("token").agg(first, F.count("*").alias("k")).where("k > 1").select(
        "token", F.col("l.cls").alias("a"), F.col("l.n").alias("na")), "ngram-leaders")
    led = (postings.join(leaders, "token").where((F.col("cls") != F.col("a")) & _sizes_fit(F.col("na"), F.col("n")))
           .groupBy(F.col("cls").alias("b"), "a", "na").agg(F.count("*").alias("c")))
    # a list holds a leader for every prefix shingle of the class at most
    most = F.slice(F.sort_array(F.collect_list(F.struct("c", "a", "na")), asc=False), 1, LEADERS)
    some = saved(led.groupBy("b").agg(most.alias("m")).select("b", F.explode("m").alias("m")).select("b", "m.a", "m.na"),
                 "ngram-led")
    of_b = postings.join(some, F.col("cls") == F.col("b")).select("token", "a", "b", "na", "n")
    of_a = postings.select("token", F.col("cls").alias("a"))
    c = of_b.join(of_a, ["token", "a"]).groupBy("a", "b", "na", "n").agg(F.count("*").alias("c"))
    c = c.where(F.col("c") >= least_shared(F.col("na"), F.col("n")))
    best = c.groupBy("b").agg(F.slice(F.sort_array(F.collect_list(F.struct("c", "a")), asc=False), 1, 2).alias("m"))
    best = best.select("b", F.explode("m.a").alias("a"))
    best = saved(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "ngram-star")
    dropped(leaders, some)
    return best


def _placed(postings: DataFrame, found: DataFrame) -> DataFrame:
    """`postings` with their component `comp`."""
    return postings.join(found, F.col("cls") == F.col("id"), "left").select(
        "token", "cls", "n", "at", F.coalesce("component", "cls").alias("comp"))


def _crowded(placed: DataFrame) -> tuple[int, DataFrame]:
    """The shingles that pairs of different components share more than CROWD times
    for each of their classes, and the number of those pairs."""
    each = placed.groupBy("token", "comp").agg(F.count("*").alias("k"))
    pairs = ((F.col("k") * F.col("k") - F.col("own")) / 2).cast("long")
    crowded = saved(each.groupBy("token").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("own"))
                    .select("token", "k", pairs.alias("pairs")).where(F.col("pairs") > CROWD * F.col("k")), "ngram-crowded")
    return crowded.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0], crowded.select("token")


def _gathered(placed: DataFrame, crowded: DataFrame, heads: DataFrame, sets: DataFrame) -> DataFrame:
    """Candidates `a, b`: the classes of the crowded shingles, each with the HEADS
    classes of its shingle that come first in `heads` (cls, rank), where those are of
    other components; both have `sets`."""
    hot = placed.join(crowded, "token", "left_semi").join(sets.select("cls"), "cls", "left_semi")
    hot = saved(hot.join(heads, "cls"), "ngram-hot")
    first = F.slice(F.sort_array(F.collect_list(F.struct("rank", "cls", "n", "comp"))), 1, HEADS)
    # a partial list of every task and bucket, so no list holds a whole shingle
    some = hot.groupBy("token", F.pmod(F.xxhash64("cls"), F.lit(64)).alias("s")).agg(first.alias("m"))
    some = some.groupBy("token").agg(F.slice(F.sort_array(F.flatten(F.collect_list("m"))), 1, HEADS).alias("m"))
    lead = saved(some.select("token", F.explode("m").alias("m")).select(
        "token", F.col("m.cls").alias("h"), F.col("m.n").alias("nh"), F.col("m.comp").alias("comph")), "ngram-heads")
    near = (hot.join(lead, "token").where((F.col("comp") != F.col("comph")) & _sizes_fit(F.col("n"), F.col("nh")))
            .select(F.least("cls", "h").alias("a"), F.greatest("cls", "h").alias("b")))
    near = saved(near.distinct(), "ngram-gathered")
    dropped(hot, lead)
    return near


def _groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The survey, and (id, component) over the classes that link with others."""
    survey = _survey(docs)
    sketch = _sketch(survey)
    seen = _tokens(docs, sketch).groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"))
    shared = hash_bitmap(seen.where("lo < hi"), "token")
    postings = saved(_tokens(docs, sketch, shared).distinct(), "ngram-postings")

    best = _led(postings)
    known = _ends(best)
    sets = _sets(docs, sketch, known)
    links = saved(_verified(best, sets), "ngram-links")
    found = saved(components(links), "ngram-components")

    # classes of crowded shingles meet heads of them until that gathers few more
    front = postings.where(_early(F.col("n"), F.col("at"), F.col("n"), F.col("at"))[0])
    size = postings.groupBy("cls").agg(F.count("*").alias("size"))
    pairs, crowded = _crowded(_placed(front, found))
    turn = 0
    while pairs:
        # first those with most shared shingles, then others
        heads = size.select("cls", F.struct((F.col("size") * F.lit(-1 if turn == 0 else 0)).alias("r"),
                                            F.xxhash64("cls", F.lit(turn)).alias("h")).alias("rank"))
        near = _gathered(_placed(front, found), crowded, heads, sets)
        links = links.unionByName(saved(_verified(near, sets), "ngram-links"))
        found = saved(components(links), "ngram-components")
        before, (pairs, crowded) = pairs, _crowded(_placed(front, found))
        turn += 1
        if 2 * pairs > before:
            break

    # classes of different components, pair by pair
    placed = saved(_placed(postings, found), "ngram-placed")
    dropped(postings)
    mixed = saved(placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                  .where("lo < hi").select("token"), "ngram-mixed")
    left = saved(placed.join(mixed, "token", "left_semi"), "ngram-left")
    dropped(placed, mixed)
    x, y = left.alias("x"), left.alias("y")
    early, few = _early(F.col("x.n"), F.col("x.at"), F.col("y.n"), F.col("y.at"))
    pairs = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.cls") < F.col("y.cls"))
                    & (F.col("x.comp") != F.col("y.comp")) & _sizes_fit(F.col("x.n"), F.col("y.n")) & early)
             .groupBy(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"), few.alias("few")).agg(F.count("*").alias("c"))
             .where(F.col("c") >= F.col("few")).select("a", "b"))
    pairs = saved(pairs, "ngram-pairs")
    others = _sets(docs, sketch, _ends(pairs), known)
    more = saved(_verified(pairs, sets.unionByName(others)), "ngram-links")
    dropped(sets, others)
    return survey, saved(components(links.unionByName(more)), "ngram-components")


def _classes(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Per class `cls, component_id, rep_cls`: the smallest doc_id of the group
    and the class that holds it."""
    own = saved(members.where("cls is not null").groupBy("cls").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id")).alias("d")), "ngram-classes")
    placed = saved(own.join(groups, F.col("cls") == F.col("id"), "left").select(
        "cls", "d", F.coalesce("component", "cls").alias("comp")), "ngram-placed")
    low = saved(placed.groupBy("comp").agg(F.min(F.struct("d", "cls")).alias("m")), "ngram-low")
    result = saved(placed.join(low, "comp").select("cls", F.col("m.d.doc_id").alias("component_id"),
                                                   F.col("m.cls").alias("rep_cls")), "ngram-result")
    dropped(own, placed, low)
    return result


def ngram_groups(docs: DataFrame) -> DataFrame:
    """`doc_id, n_shingles, component_id`, one row per document."""
    survey, groups = _groups(docs)
    members = _members(survey)
    classes = _classes(members, groups).select(F.col("cls").alias("k"), "component_id")
    # documents without words link with nothing; spread them over the join
    key = F.coalesce("cls", F.xxhash64("doc_id", F.lit("no words")))
    return (members.withColumn("key", key).join(classes, (F.col("key") == F.col("k")) & F.col("cls").isNotNull(), "left")
            .select("doc_id", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """Filter form: one document of each group, the one with the smallest doc_id,
    and every document without words; with their own columns."""
    survey, groups = _groups(docs)
    # one key for class and id: rows with a null id meet as well, and the copies of
    # a kept row lie together after the join, so that texts are shuffled once
    reps = _classes(_members(survey), groups).where("cls = rep_cls").select(
        F.struct("cls", F.col("component_id").alias("match_id")).alias("rep"))
    dropped(survey)
    names = [f"own_{i}" for i in range(len(docs.columns))]
    own = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names)],
                      F.col("doc_id").alias("match_id"), F.col("text").alias("match_text"))

    def add(b):
        text = b.column("match_text")
        for lo, hi, batch in text_batches(text, SET_BYTES):
            _, _, n, cls = shingle_sets(batch)
            part = b.slice(lo, hi - lo)
            cols = [part.column(i) for i in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(signed(cls), pa.int64(), mask=n == 0)],
                                             [*names, "match_id", "cls"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])
    marked = arrow_apply(own, add, f"{fields}, cls long")
    kept = (marked.where("cls is not null").withColumn("row", F.struct("cls", "match_id")).drop("cls", "match_id")
            .join(reps, F.col("row") == F.col("rep")).dropDuplicates(["row"]))
    out = kept.select(*names).unionByName(marked.where("cls is null").select(*names))
    return out.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])
