"""JDBC tables and queries."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 200000  # fixed value: rows per fetch
BATCH_SIZE = 1048576  # fixed value: rows per insert batch


@dataclass(frozen=True)
class JdbcConnection:
    url: str
    driver: str
    options: dict[str, str] = field(default_factory=dict)

    def common(self) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, **self.options}


def is_query(text: str) -> bool:
    """Whether a source text is a query rather than a table name."""
    return re.search(r"\bselect\s", text, re.IGNORECASE) is not None


def read_options(
    connection: JdbcConnection,
    source: str,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 4,
    fetch_size: int = FETCH_SIZE,
    prepare: str | None = None,
) -> dict[str, str]:
    """Reader options for a table, or for a query as a derived table.

    With a partition column and bounds, ``partitions`` tasks read side by side; without, one
    task reads all. ``prepare`` takes the ``WITH`` part of a query that starts with one.
    """
    table = f"({source}) TEMP" if is_query(source) else source
    options = {**connection.common(), "dbtable": table, "fetchsize": str(fetch_size)}
    if prepare:
        options["prepareQuery"] = prepare
    if partition_column:
        if lower is None or upper is None:
            raise ValueError("a partition column needs bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, connection: JdbcConnection, source: str, **options) -> DataFrame:
    """Table or query of a database; options as in :func:`read_options`."""
    return spark.read.format("jdbc").options(**read_options(connection, source, **options)).load()


def write_options(
    connection: JdbcConnection, table: str, partitions: int | None = None, batch_size: int = BATCH_SIZE
) -> dict[str, str]:
    """Writer options: big insert batches, READ_COMMITTED."""
    options = {
        **connection.common(),
        "dbtable": table,
        "batchsize": str(batch_size),
        "isolationLevel": "READ_COMMITTED",
    }
    if partitions:
        options["numPartitions"] = str(partitions)
    return options


def write_jdbc(df: DataFrame, connection: JdbcConnection, table: str, mode: str = "append", **options) -> None:
    """Insert in batches. A retried task would insert twice, so a caller that needs
    exactly-once loads a staging table and moves it in one statement."""
    df.write.format("jdbc").mode(mode).options(**write_options(connection, table, **options)).save()
