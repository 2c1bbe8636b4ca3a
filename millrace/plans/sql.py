"""Parameterised SQL over named inputs, and sets of views."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.macros import register_macros


def render(text: str, args: Mapping[str, object]) -> str:
    """Run-time placeholders ``[[ name ]]`` replaced as text; a month ``yyyy-MM`` gets ``-01``."""
    for name, value in args.items():
        shown = str(value)
        if name == "run_date" and len(shown) == 7:
            shown += "-01"
        for spelling in (f"[[ {name} ]]", f"[[{name}]]"):
            text = text.replace(spelling, shown)
    return text


def load_sql(folder: str | Path, name: str) -> str:
    """Text of the query file ``name`` anywhere below ``folder``; it must be unique."""
    found = sorted(Path(folder).rglob(name))
    if len(found) != 1:
        raise FileNotFoundError(f"{name}: {len(found)} files found below {folder}")
    return found[0].read_text()


def run_sql(
    spark: SparkSession,
    text: str,
    args: Mapping[str, object] | None = None,
    refs: Mapping[str, DataFrame] | None = None,
    params: Mapping[str, object] | None = None,
) -> DataFrame:
    """Run a query. ``refs`` are inputs by view name, ``params`` fill ``:name`` markers as
    values, ``args`` fill ``[[ name ]]`` as text. The date macros are available. The query is
    analysed at once, so the views are gone again afterwards."""
    if not spark.catalog.functionExists("text_to_datetime"):
        register_macros(spark)
    refs = refs or {}
    for name, df in refs.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(render(text, args or {}), args=dict(params or {}))
    finally:
        for name in refs:
            spark.catalog.dropTempView(name)


def create_views(
    spark: SparkSession, folder: str | Path, pattern: str = "*.sql", database: str | None = None
) -> list[str]:
    """One view per query file, named after the file; existing views are replaced.

    Without a database the views belong to the session.
    """
    names = []
    for path in sorted(Path(folder).rglob(pattern)):
        name = f"{database}.{path.stem}" if database else path.stem
        kind = "VIEW" if database else "TEMPORARY VIEW"
        spark.sql(f"CREATE OR REPLACE {kind} {name} AS {path.read_text()}")
        if database:
            spark.catalog.refreshTable(name)
        names.append(name)
    return names
