"""Sharding by weighted rendezvous hashing.

Every record key draws one number per shard from a hash of (key, shard) and
goes to the shard with the best weighted draw, -ln(u) / weight smallest.  A
shard's draw does not depend on the other shards, so adding one shard moves
only the rows that it wins, and changing one weight moves rows only into or
out of that shard.

Defined results: a null key is a key like any other (one value); rows with the
same key share a shard; an empty table gives an empty table; other columns pass
through (a column already named like an output is replaced).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DRAW_HEX = 13  # 52 bits: exact in a double
SLOT_BUCKETS = 4096


def draw(key: Column, shard: int) -> Column:
    """A whole number below 2**52 from the key and the shard's number."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("\0null")), F.lit(f"#{shard}"))
    return F.conv(F.substring(F.md5(text), 1, DRAW_HEX), 16, 10).cast("long")


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard that wins `key`; equal draws go to the smaller number."""
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("weights must be positive")
    scored = [
        F.struct((-F.ln((draw(key, s) + 0.5) / float(1 << 4 * DRAW_HEX)) / float(w)).alias("score"),
                 F.lit(s).alias("shard"))
        for s, w in enumerate(weights)
    ]
    return (F.least(*scored) if len(scored) > 1 else scored[0])["shard"]


def assign(df: DataFrame, key: str, weights: Sequence[float], out: str = "shard") -> DataFrame:
    """`df` with its shard; a projection, no shuffle."""
    return df.withColumn(out, rendezvous(F.col(key), weights))


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str) -> None:
    """One folder per shard, written in parallel by every task that holds rows of it."""
    assign(df, key, weights).write.partitionBy("shard").parquet(path)


def with_slots(rows: DataFrame, group: str, order: Sequence[str], out: str = "slot",
               buckets: int = SLOT_BUCKETS) -> DataFrame:
    """Number the rows of each `group` from 0 without gaps.

    A group may hold any share of all rows, so it is cut into hash buckets: the
    rows count within their bucket, and each bucket starts where the ones before
    it end (a table of groups x buckets rows).  Equal rows are counted before
    the shuffle and numbered out again afterwards, so a row repeated very often
    is one row here.
    """
    cols = rows.columns
    bucket = F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")
    counted = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).withColumn("_b", bucket)
    sizes = counted.groupBy(group, "_b").agg(F.sum("_n").alias("_size"))
    upto = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(group).alias("_g"), F.col("_b").alias("_c"),
                          F.coalesce(F.sum("_size").over(upto), F.lit(0)).alias("_start"))
    within = (Window.partitionBy(group, "_b").orderBy(*[F.col(c).asc_nulls_first() for c in order])
              .rowsBetween(Window.unboundedPreceding, -1))
    first = F.col("_start") + F.coalesce(F.sum("_n").over(within), F.lit(0))
    return (counted.join(F.broadcast(starts), (F.col(group) == F.col("_g")) & (F.col("_b") == F.col("_c")))
            .withColumn("_first", first)
            .select(*cols, F.explode(F.sequence("_first", F.col("_first") + F.col("_n") - 1)).alias(out)))


SHARDS = 8


def shard_documents(docs: DataFrame, shards: int = SHARDS, weights: Sequence[float] | None = None) -> DataFrame:
    """Query form over `documents`: doc_id decides the shard, with one shard
    more in `grown_shard`; `slot` numbers the rows of a shard.  Null text has
    size 1 and the checksum of an empty text."""
    weights = list(weights or [1.0] * shards)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        rendezvous(F.col("doc_id"), weights).alias("shard"),
        rendezvous(F.col("doc_id"), [*weights, 1.0]).alias("grown_shard"),
    )
    out = with_slots(rows, "shard", ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
