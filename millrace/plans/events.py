"""Event row of every job run."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import SparkSession

from millrace.context import RunContext
from millrace.plans.table import WarehouseTable

EVENT_SCHEMA = (
    "LOG_DTTM timestamp_ntz, BATCH_JOB_ID string, RUN_DATE string, ENVIRONMENT_NAME string, "
    "TABLE_NAME string, EVENT_NAME string, EVENT_STAGE string, EVENT_DATA string, "
    "START_DTTM timestamp_ntz, END_DTTM timestamp_ntz"
)
REFRESH_EVENT = "REFRESH_DATA"  # fixed value


@dataclass
class EventLog:
    """Append-only table of job runs."""

    spark: SparkSession
    name: str

    def append(self, row: tuple) -> None:
        WarehouseTable(self.spark, self.name).append(self.spark.createDataFrame([row], EVENT_SCHEMA))


def event_data(
    sources: Sequence[str], source_format: str, method: str | None, rows: int | None, tags: Sequence[str]
) -> str:
    return json.dumps(
        {
            "source_tables": list(sources),
            "source_format": source_format,
            "refresh_method": method,
            "n_rows": rows,
            "tags": list(tags) or None,
        }
    )


def logged(
    log: EventLog | None,
    ctx: RunContext,
    table: str,
    sources: Sequence[str],
    source_format: str,
    method: str | None,
    work: Callable[[], int],
    clock: Callable[[], datetime] = datetime.now,
) -> int:
    """Run ``work`` and log SUCCESS with its row count, or FAILED and raise on."""
    if log is None:
        return work()
    start = clock()

    def record(stage: str, rows: int | None) -> None:
        end = clock()
        data = event_data(sources, source_format, method, rows, ctx.tags)
        log.append(
            (end, ctx.batch_job_id, ctx.run_date, ctx.environment, table, REFRESH_EVENT, stage, data, start, end)
        )

    try:
        rows = work()
    except Exception:
        record("FAILED", None)
        raise
    record("SUCCESS", rows)
    return rows
