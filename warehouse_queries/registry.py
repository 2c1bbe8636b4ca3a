"""Registry of queries and their SQL, and access to the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.plans.table import ensure_database
from millrace.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL if there is one."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_database(spark: SparkSession) -> str:
    """A database of its own in the shared scratch folder, for round trips."""
    name = f"wh_{uuid.uuid4().hex[:12]}"
    ensure_database(spark, name, scratch_dir(spark, name))
    return name
