"""Registered queries: one per operator, each with its DuckDB equivalent where SQL can say it."""

import sys

from pyspark import cloudpickle

from warehouse_queries import (  # noqa: F401
    calendars,
    changes,
    columns,
    jobs,
    refreshes,
    relations,
    schemas,
    tables,
)
from warehouse_queries.registry import ORACLE, QUERIES

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ORACLE", "QUERIES"]
