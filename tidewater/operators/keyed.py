"""Keyed-table semantics: last write per key wins, whole row replaced.

`latest_per_key` is the current view of an upsert stream.  It aggregates
with `max_by(row, order)`, which Spark runs as a partial aggregate on the map
side and a final one after the shuffle, so a key that holds a third of all
rows is folded to one row per map task before it is shuffled; a
`row_number()` window would instead sort that whole key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                   keep: Column | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Last row per key by `order`.

    `keep` restricts the candidates without a filter: rows failing it get a
    null ordering, which `max_by` skips, and keys with no candidate are
    dropped after the aggregate.  A filter placed on a parse output would be
    pushed under the parse projection and re-evaluate the parse inside each
    CASE branch; this form parses once.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in (columns or df.columns) if c not in keys]
    ordering = F.struct(*order)
    if keep is not None:
        ordering = F.when(keep, ordering)
    latest = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest) if rest else F.lit(True), ordering).alias("_row")
    )
    if keep is not None:
        latest = latest.where(F.col("_row").isNotNull())
    return latest.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """SELECT COUNT(*): one row."""
    return df.agg(F.count(F.lit(1)).alias(name))


def sample_rows(df: DataFrame, columns: Sequence[str], n: int = 10,
                order: Sequence[str] | None = None) -> DataFrame:
    """`SELECT cols ... LIMIT n` with an explicit order so the sample is
    reproducible; planned as a per-partition top-n and one merge of n rows
    per partition (TakeOrderedAndProject), never a full sort."""
    order = list(order or columns[:1])
    return df.select(*columns).orderBy(*order).limit(n)
