"""Enrichment of a record stream with dimension tables.

Dimensions are joined through `joins.join_dimension`: broadcast when they are
small in bytes; a large dimension (customers at scale) stays a shuffle join,
which AQE converts or splits at run time.  A
streaming fact side joined to a static dimension works unchanged
(stream-static join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.joins import join_dimension


def enrich_events(events: DataFrame, customer: DataFrame, nation: DataFrame,
                  region: DataFrame, where: Column | None = None) -> DataFrame:
    """`where` filters the events first; on columns of a file it reaches the scan."""
    if where is not None:
        events = events.where(where)
    cust = customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    geo = join_dimension(
        nation.select("n_nationkey", "n_name", "n_regionkey"),
        region.select("r_regionkey", "r_name"),
        F.col("n_regionkey") == F.col("r_regionkey"), "left",
    ).select("n_nationkey", "n_name", "r_name")
    with_cust = join_dimension(
        events.select("event_id", "event_type", "user_id"), cust,
        F.col("user_id") == F.col("c_custkey"), "left",
    )
    out = join_dimension(with_cust, geo, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return out.select("event_id", "event_type", "user_id", "c_mktsegment", "n_name", "r_name")
