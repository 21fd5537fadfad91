"""Connected components of an edge table, as rounds of joins.

Rounds of large-star and small-star: every node hands its smaller neighbour on
to its larger ones, until the edges form one star per component.  Each round is
written to the shared folder, so a lost executor repeats one round at most; the
round before is removed then.
Nothing but two sums per round reaches the driver.  Group minima are
pre-aggregated and joined back from written tables, so Spark can split the join
of a node with very many neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import dropped, saved


def _min_neighbour(pairs: DataFrame, name: str) -> DataFrame:
    return saved(pairs.groupBy("u").agg(F.min("v").alias("m")), name)


def components(edges: DataFrame) -> DataFrame:
    """`id, component` for every end of an edge (`a`, `b`): component is the
    smallest id reachable.  Loops and repeated edges do no harm; rows with a
    null end are left out; an empty table gives an empty table."""
    ends = edges.where("a is not null and b is not null and a <> b")
    e = saved(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _min_neighbour(both, "cc-large")
        low = least.select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        large = saved(large, "cc-large-edges")
        low = _min_neighbour(large, "cc-small")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, e = e, saved(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
        dropped(least, large, low, old)
        # equal counts and hash sums of consecutive rounds: nothing moved
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if before == (now["n"], now["s"]):
            break
        before = (now["n"], now["s"])
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
