"""Audit columns every job adds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.context import RunContext


def row_file_name() -> Column:
    """Name of the file a row was read from."""
    return F.col("_metadata.file_name")


def add_audit(df: DataFrame, ctx: RunContext, file_name: Column | str | None = None) -> DataFrame:
    """BATCH_JOB_ID and EDW_UPDATE_DTTM, and FILE_NAME when one is given."""
    columns = {
        "BATCH_JOB_ID": F.lit(ctx.batch_job_id),
        "EDW_UPDATE_DTTM": F.lit(ctx.update_text),
    }
    if file_name is not None:
        columns["FILE_NAME"] = F.lit(file_name) if isinstance(file_name, str) else file_name
    return df.withColumns(columns)
