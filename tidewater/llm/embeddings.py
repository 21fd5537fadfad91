"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables and
an exact rerank.

A rotation is learned on a bounded sample (the SAMPLE vectors with the smallest
hash of vec_id) so that the signs of the rotated, centred unit vectors are
balanced binary codes.  Every vector gets a code of BITS bits, cut into TABLES
parts; two codes that differ in at most RADIUS bits agree on some part up to
RADIUS // TABLES bits, so looking up every part and its single-bit variants
finds all of them.  Candidates within RADIUS are rechecked by cosine in double
precision on the original vectors.

Equal vectors of a label form one class, which is searched once and weighs as
many vectors as it holds.

Defined results: vectors that are null, empty, zero or hold a null or non-finite
component, and vectors without a label, link with nothing; vectors of different
length never link; repeated rows of a vec_id are separate vectors that count each
other; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import saved
from tidewater.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COSINE = 0.93
SAMPLE = 4096
ROUNDS = 25
BITS = 64
TABLES = 8
RADIUS = 15


def fit_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): principal directions times the rotation that brings
    the projected sample closest to the corners of the cube."""
    dims = sample.shape[1]
    rng = np.random.RandomState(seed)
    mean = sample.mean(axis=0) if len(sample) else np.zeros(dims)
    k = min(bits, dims)
    if len(sample) > 1:
        centred = sample - mean
        _, vectors = np.linalg.eigh(centred.T @ centred)
        basis = vectors[:, ::-1][:, :k]
    else:
        basis = np.eye(dims)[:, :k]
    rotation = np.linalg.qr(rng.standard_normal((k, k)))[0]
    v = (sample - mean) @ basis
    for _ in range(rounds if len(sample) > 1 else 0):
        corners = np.where(v @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(corners.T @ v)
        rotation = (left @ right).T
    out = basis @ rotation
    if k < bits:  # more bits than dimensions: random directions besides
        out = np.hstack([out, rng.standard_normal((dims, bits - k))])
    return mean, out


def usable(v: Column, label: Column) -> Column:
    """Has a label, only finite components and a length above zero."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _codes(classes: DataFrame, models):
    """Adds `code`: one sign bit per learned direction."""
    @F.pandas_udf("long")
    def code(vectors: pd.Series) -> pd.Series:
        out = np.zeros(len(vectors), np.int64)
        sizes = vectors.map(len).to_numpy()
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            x = unit(np.stack(vectors.iloc[at].to_numpy()))
            mean, projection = models[int(size)] if int(size) in models else fit_rotation(np.zeros((0, size)))
            bits = (x - mean) @ projection >= 0
            out[at] = np.packbits(bits, axis=1, bitorder="little").view("<i8")[:, 0]
        return pd.Series(out)

    return classes.withColumn("code", code("v"))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _parts() -> Column:
    width = BITS // TABLES
    return F.array(*[F.shiftrightunsigned("code", width * t).bitwiseAND(F.lit((1 << width) - 1)) for t in range(TABLES)])


def _candidates(codes: DataFrame) -> DataFrame:
    """Pairs `a < b` of classes of one label whose codes differ in RADIUS bits
    at most, by the tables of parts."""
    width = BITS // TABLES
    index = codes.select("cls", "label", "code", F.posexplode(_parts()).alias("t", "part"))
    near = F.array(F.col("part"), *[F.col("part").bitwiseXOR(F.lit(1 << b).cast("long")) for b in range(width)])
    probes = index.select(F.col("cls").alias("a"), F.col("label").alias("la"), F.col("code").alias("ca"),
                          F.col("t").alias("ta"), F.explode(near).alias("pa"))
    hit = ((F.col("la") == F.col("label")) & (F.col("ta") == F.col("t")) & (F.col("pa") == F.col("part"))
           & (F.col("a") < F.col("cls")) & (F.bit_count(F.col("ca").bitwiseXOR(F.col("code"))) <= RADIUS))
    # a pair is found by many parts: keep it from the first table only
    differs = F.col("ca").bitwiseXOR(F.col("code"))
    first = F.lit(True)
    for t in range(1, TABLES):
        earlier = [F.bit_count(F.shiftrightunsigned(differs, width * s).bitwiseAND(F.lit((1 << width) - 1))) > RADIUS // TABLES
                   for s in range(t)]
        clear = earlier[0]
        for e in earlier[1:]:
            clear = clear & e
        first = first & ((F.col("t") != t) | clear)
    return probes.join(index, hit & first).select("a", F.col("cls").alias("b"))


def cosine(x: str, y: str) -> Column:
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda s, t: s * t), F.lit(0.0), lambda acc, z: acc + z)
    return dot(x, y) / F.sqrt(dot(x, x)) / F.sqrt(dot(y, y))


def near_duplicates(vectors: DataFrame, least: float = COSINE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links): rows `vec_id, cls` (null when unusable), classes
    `cls, size`, links `a, b` between classes with cosine >= `least`."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", "label", F.when(usable(v, F.col("label")), v).alias("v"))
    # scaled by its largest component, so squares neither overflow nor vanish
    top = F.array_max(F.transform("v", lambda x: F.abs(x)))
    rows = rows.withColumn("top", top).withColumn("v", F.transform("v", lambda x: x / F.col("top"))).drop("top")
    rows = saved(rows, "itq-rows")
    good = rows.where("v is not null")
    classes = saved(good.groupBy("label", "v").agg(F.min("vec_id").alias("low"), F.count("*").alias("size"))
                    .withColumn("cls", F.xxhash64("label", "v")), "itq-classes")
    models = {}
    sample = (classes.orderBy(F.xxhash64("low"), "cls").limit(SAMPLE).select("v").toPandas()["v"])
    by_size: dict = {}
    for x in sample:
        by_size.setdefault(len(x), []).append(x)
    for size, xs in by_size.items():
        models[size] = fit_rotation(unit(np.stack(xs)))
    codes = saved(_codes(classes, models).select("cls", "label", "code"), "itq-codes")
    pairs = saved(_candidates(codes), "itq-pairs")
    side = lambda s: classes.select(F.col("cls").alias(f"c{s}"), F.col("v").alias(f"v{s}"))
    near = (pairs.join(side("a"), F.col("a") == F.col("ca")).join(side("b"), F.col("b") == F.col("cb"))
            .where((F.size("va") == F.size("vb")) & (cosine("va", "vb") >= least)).select("a", "b"))
    links = saved(near, "itq-links")
    placed = rows.withColumn("cls", F.when(F.col("v").isNotNull(), F.xxhash64("label", "v")))
    return placed.select("vec_id", "cls"), classes.select("cls", "low", "size"), links


def embedding_groups(vectors: DataFrame) -> DataFrame:
    """Query form: `vec_id, n_links, component_id, kept`, one row per vector."""
    rows, classes, links = near_duplicates(vectors)
    sized = lambda here, there: links.select(F.col(here).alias("cls"), F.col(there).alias("other"))
    sizes = classes.select(F.col("cls").alias("o"), "size")
    counts = saved(sized("a", "b").unionByName(sized("b", "a")).join(sizes, F.col("other") == F.col("o"))
                   .groupBy("cls").agg(F.sum("size").alias("around")), "itq-counts")
    groups = saved(components(links), "itq-components")
    placed = saved(classes.join(groups, F.col("cls") == F.col("id"), "left")
                   .select("cls", "low", "size", F.coalesce("component", "cls").alias("comp")), "itq-placed")
    low = saved(placed.groupBy("comp").agg(F.min("low").alias("component_id")), "itq-low")
    result = (placed.join(low, "comp").join(counts, "cls", "left")
              .select(F.col("cls").alias("k"), (F.coalesce("around", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                      "component_id"))
    result = saved(result, "itq-result")
    key = F.coalesce("cls", F.xxhash64("vec_id", F.lit("unusable")))
    out = rows.withColumn("key", key).join(result, (F.col("key") == F.col("k")) & F.col("cls").isNotNull(), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
