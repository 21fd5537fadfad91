"""Joins against dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """A plain join: the planner broadcasts a side by its size in bytes
    (`spark.sql.autoBroadcastJoinThreshold`), AQE again by its measured size, and
    otherwise a shuffle join runs whose skewed partitions AQE splits.  No job runs
    while the query is being built."""
    return fact.join(dim, on, how)
