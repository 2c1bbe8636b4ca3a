"""File exports: parquet, delimited text, one directory per month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_FILE = 1048576  # fixed value: rows of one output file


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    counter = Observation()
    return df.observe(counter, F.count(F.lit(1)).alias("n")), counter


def write_parquet(df: DataFrame, path: str, mode: str = "append", **options) -> int:
    """Parquet files; returns the rows written, counted on the way."""
    rows, counter = _counted(df)
    rows.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).options(**options).parquet(path)
    return counter.get["n"]


def write_delimited(
    df: DataFrame, path: str, delimiter: str = "|", single_file: bool = False, mode: str = "overwrite"
) -> int:
    """Text with header, UTF-8 and CRLF line ends; the name must contain ``.csv``.

    A value is quoted only if it holds a delimiter, quote or line break; quotes are doubled,
    NULL and empty text are empty, blanks at the ends stay, times are ``yyyy-MM-dd HH:mm:ss``
    with their fraction if there is one. A line break inside a value is written as CRLF too.
    Tasks write side by side; ``single_file`` funnels the rows through one task, so it is
    only for exports a person opens.
    """
    if ".csv" not in path.lower():
        raise ValueError("the path must contain .csv")
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    rows, counter = _counted(df.withColumns({c: F.col(c).cast("string") for c in times}) if times else df)
    out = rows.coalesce(1) if single_file else rows
    options = {
        "header": True,
        "delimiter": delimiter,
        "lineSep": "\r\n",
        "encoding": "UTF-8",
        "escape": '"',
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    out.write.mode(mode).options(**options).csv(path)
    return counter.get["n"]


def backup_by_month(df: DataFrame, column: str, path: str) -> int:
    """One directory ``month=yyyy-MM-01`` per month in a single job; months present are replaced."""
    month = F.date_format(column, "yyyy-MM-'01'")
    rows, counter = _counted(df.withColumn("month", month))
    (
        rows.hint("rebalance", F.col("month"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("month")
        .parquet(path)
    )
    return counter.get["n"]


def write_sink(df: DataFrame, fmt: str, path: str, **options) -> int:
    """Write to a file sink by format name; an unknown format is an error."""
    writers = {"parquet": write_parquet, "csv": write_delimited}
    if fmt not in writers:
        raise ValueError(f"unknown sink format {fmt}")
    return writers[fmt](df, path, **options)
