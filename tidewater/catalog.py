"""Catalog set-up and inspection: schema (keyspace) and target table.

Both statements are idempotent.  Spark enforces no primary key and no NOT
NULL on a parquet table, so the key is kept by `sinks.keyed_table` and the
required fields by `operators.decode`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidewater.config import TableSettings
from tidewater.schemas import USER_V1


def _ident(name: str) -> str:
    if not name.replace("_", "").isalnum():
        raise ValueError(f"not a plain identifier: {name!r}")
    return f"`{name}`"


def create_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_ident(schema)}")


def create_table(spark: SparkSession, schema: str, table: str,
                 columns: StructType = USER_V1, location: str | None = None) -> None:
    cols = ", ".join(f"{_ident(f.name)} {f.dataType.simpleString().upper()}" for f in columns.fields)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_ident(schema)}.{_ident(table)} ({cols}) USING parquet{where}"
    )


def setup_schema(spark: SparkSession, settings: TableSettings = TableSettings(),
                 location: str | None = None) -> None:
    """Schema then table; raises on failure instead of returning False."""
    create_schema(spark, settings.schema)
    create_table(spark, settings.schema, settings.table, location=location)


def show_schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS")


def show_tables(spark: SparkSession, schema: str) -> DataFrame:
    """Note: also lists session temp views."""
    return spark.sql(f"SHOW TABLES IN {_ident(schema)}")


def describe_table(spark: SparkSession, schema: str, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {_ident(schema)}.{_ident(table)}")


def publish_view(spark: SparkSession, view: DataFrame, schema: str, table: str) -> None:
    """Overwrite the catalog table with a keyed table's current view, so
    plain SQL readers (`SELECT COUNT(*)`, `LIMIT 10`) see it."""
    view.write.insertInto(f"{_ident(schema)}.{_ident(table)}", overwrite=True)
