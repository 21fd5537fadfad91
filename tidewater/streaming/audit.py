"""What a finished or running query holds in its state, read from its checkpoint.

Spark's state data source reads the state store of one stateful operator as a
table: the key and the value of every entry, as of the last committed batch or an
earlier one.  Nothing is restarted, and the rows stay on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stateful_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per state store of the query: operator, name, partitions, batches."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None,
               variable: str | None = None) -> DataFrame:
    """The entries of one operator's store: the columns of its key and value.
    `variable` names a state variable of a stateful processor."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    if variable:
        reader = reader.option("stateVarName", variable)
    rows = reader.load(checkpoint)
    return rows.select(*[f"{c}.*" for c in ("key", "value") if c in rows.columns])
