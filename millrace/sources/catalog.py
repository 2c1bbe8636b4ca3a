"""Metadata of tables in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def split_name(table: str) -> tuple[str, str]:
    """``SCHEMA.TABLE`` in its two parts; exactly one dot is allowed."""
    parts = table.split(".")
    if len(parts) != 2 or not all(parts):
        raise ValueError(f"table name must be SCHEMA.TABLE: {table}")
    return parts[0], parts[1]


def table_exists(spark: SparkSession, table: str) -> bool:
    split_name(table)
    return spark.catalog.tableExists(table)


def sink_schema(spark: SparkSession, table: str) -> T.StructType | None:
    """Schema of a table, or None if it does not exist."""
    return spark.table(table).schema if table_exists(spark, table) else None


def sink_metadata(spark: SparkSession, table: str) -> DataFrame:
    """Column id, name, type, text length, precision and nullability of a table."""
    rows = []
    for i, f in enumerate(spark.table(table).schema.fields):
        length = getattr(f.dataType, "length", -1 if isinstance(f.dataType, T.StringType) else None)
        precision = getattr(f.dataType, "precision", None)
        rows.append((i + 1, f.name, f.dataType.simpleString(), length, precision, f.nullable))
    return spark.createDataFrame(
        rows,
        "COLUMN_ID int, COL_NAME string, DATA_TYPE string, MAX_LENGTH int, PRECISION int, IS_NULLABLE boolean",
    )
