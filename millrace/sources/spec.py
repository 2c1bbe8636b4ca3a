"""A source: path, query text, connection or callable, with its format."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from millrace.sources.files import read_files
from millrace.sources.jdbc import JdbcConnection, read_jdbc


@dataclass(frozen=True)
class Source:
    """``fmt`` is parquet, csv, txt, xlsx, excel, sql, table, jdbc or memory."""

    data: str | Sequence[str] | Callable | DataFrame | pd.DataFrame
    fmt: str
    options: dict = field(default_factory=dict)
    connection: JdbcConnection | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        if self.fmt == "sql":
            from millrace.plans.sql import run_sql

            return run_sql(spark, self.data, **self.options)
        if self.fmt == "table":
            return spark.table(self.data)
        if self.fmt == "jdbc":
            return read_jdbc(spark, self.connection, self.data, **self.options)
        if self.fmt == "memory":
            return from_memory(spark, self.data)
        return read_files(spark, self.data, self.fmt, **self.options)

    def tables(self) -> list[str]:
        """What the event row names as sources."""
        if self.fmt == "memory":
            return []
        return [self.data] if isinstance(self.data, str) else [str(p) for p in self.data]


def from_memory(spark: SparkSession, data: DataFrame | pd.DataFrame | Callable) -> DataFrame:
    """A Spark or pandas frame, or a callable that returns one (given the session if it wants it)."""
    if callable(data) and not isinstance(data, (DataFrame, pd.DataFrame)):
        import inspect

        wanted = [p for p in inspect.signature(data).parameters.values() if p.default is p.empty]
        data = data(spark) if wanted else data()
    return data if isinstance(data, DataFrame) else spark.createDataFrame(data)
