"""Jobs: source, normalise, reconcile, transform, audit, refresh, log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace as with_values

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.context import RunContext
from millrace.functions.audit import add_audit
from millrace.functions.naming import normalize_columns
from millrace.operators.changes import (
    cap_files,
    changed_content,
    new_files,
    unlogged,
)
from millrace.operators.refresh import PATH_COLUMN, Mode, RefreshSpec, as_datetime, parse_mode, path_column
from millrace.operators.relational import group_bounds
from millrace.operators.schema import SchemaPolicy, Transform, new_fields, reconcile
from millrace.plans.events import EventLog, logged
from millrace.plans.exports import backup_by_month, write_delimited
from millrace.plans.table import WarehouseTable
from millrace.session import stage, unstage
from millrace.sources.files import read_files
from millrace.sources.listing import hash_files
from millrace.sources.spec import Source


def _steps(transforms: Transform | Sequence[Transform] | None) -> list[Transform]:
    return [transforms] if callable(transforms) else list(transforms or [])


def load_frame(
    df: DataFrame,
    table: WarehouseTable,
    ctx: RunContext,
    spec: RefreshSpec,
    transforms: Transform | Sequence[Transform] | None = None,
    policy: SchemaPolicy = SchemaPolicy(),
    file_name: str | None = None,
    keep_old_columns: bool = True,
) -> int:
    """Normalise, reconcile, transform, audit and refresh. The core of every load.

    On a full refresh, columns only the old table has stay as NULL unless
    ``keep_old_columns`` is off.
    """
    df = normalize_columns(df)
    steps = [*_steps(transforms), lambda d: add_audit(d, ctx, file_name)]
    sink = table.schema if table.exists else None
    if sink is not None and spec.replaces_all and not keep_old_columns:
        sink = None
    if sink is not None and policy.evolve and not spec.replaces_all:
        added = new_fields(df, sink)
        table.add_columns(added)
        sink = table.schema
    ready = reconcile(df, sink, steps, policy, spec.replaces_all, metadata=table)
    return table.refresh(ready, spec)


def transform_job(
    spark: SparkSession,
    source: Source,
    table: WarehouseTable,
    ctx: RunContext,
    spec: RefreshSpec | None = None,
    transforms: Transform | Sequence[Transform] | None = None,
    events: EventLog | None = None,
    **options,
) -> int:
    """Query or callable to table; by default the run date's whole month is replaced."""
    if spec is None:
        column = table.partition_column
        spec = RefreshSpec(refresh_type=Mode.PARTITION_MTD, partition_column=column, partition_value=ctx.run_date)
    method = spec.mode.value if spec.mode else None
    return logged(
        events, ctx, table.name, source.tables(), source.fmt, method,
        lambda: load_frame(source.read(spark), table, ctx, spec, transforms, **options),
    )


def ingest_job(
    spark: SparkSession,
    source: Source,
    table: WarehouseTable,
    ctx: RunContext,
    spec: RefreshSpec,
    file_name: str,
    transforms: Transform | Sequence[Transform] | None = None,
    events: EventLog | None = None,
    **options,
) -> int:
    """One file to table, with its name as FILE_NAME; CDC replaces the rows of that file."""
    if spec.mode is Mode.CDC and not spec.file_names:
        spec = with_values(spec, file_names=file_name)
    method = spec.mode.value if spec.mode else None
    return logged(
        events, ctx, table.name, source.tables(), source.fmt, method,
        lambda: load_frame(source.read(spark), table, ctx, spec, transforms, file_name=file_name, **options),
    )


def _load_files(
    spark: SparkSession,
    files: Sequence[tuple[str, str]],
    fmt: str,
    table: WarehouseTable,
    ctx: RunContext,
    spec: RefreshSpec,
    transforms: Transform | Sequence[Transform] | None,
    events: EventLog | None,
    read_options: dict | None,
) -> int:
    """Several files in one load, each row with the name and path of its file."""
    paths = [path for path, _ in files]
    if spec.mode is Mode.CDC:
        spec = with_values(spec, file_paths=paths, file_names=[name for _, name in files])
        if table.exists and path_column(table.schema.fieldNames()) is None:
            table.add_columns([T.StructField(PATH_COLUMN, T.StringType())])

    def work() -> int:
        df = read_files(spark, paths, fmt, with_file_name=True, with_path=True, **(read_options or {}))
        return load_frame(df, table, ctx, spec, transforms)

    method = spec.mode.value if spec.mode else None
    return logged(events, ctx, table.name, paths, fmt, method, work)


def imported_files(table: WarehouseTable) -> DataFrame:
    """``filename`` and ``file_path`` (NULL where only the name is known) of files in a table, from its ledger."""
    file = F.col("file")
    path = F.when(F.contains(file, F.lit("/")), file)
    return table.files().select(F.substring_index(file, "/", -1).alias("filename"), path.alias("file_path")).distinct()


def incremental_files_job(
    spark: SparkSession,
    listing: DataFrame,
    log: WarehouseTable,
    table: WarehouseTable,
    ctx: RunContext,
    fmt: str,
    pattern: str | None = None,
    ingest_type: str | Mode = Mode.CDC,
    partition_value: str | None = None,
    cap: int | None = None,
    force_rerun: bool = False,
    reload_modified: bool = False,
    transforms: Transform | Sequence[Transform] | None = None,
    events: EventLog | None = None,
    read_options: dict | None = None,
) -> list[str]:
    """Load the files that are new since the last run, and log them.

    All new files, or the ``cap`` lowest paths, go into one load; the others are left for the
    next run. A month refresh takes the newest file only, and logs the older ones with it: they
    are superseded, and must not be loaded over it later. Files are logged after the load, so a
    failed run is simply repeated; CDC makes the repeat harmless.
    """
    mode = parse_mode(ingest_type)
    seen = log.read() if log.exists else listing.where(F.lit(False))
    imported = imported_files(table) if table.exists else None
    fresh = new_files(
        listing, seen, imported, pattern, mode is Mode.MASTERDATA, force_rerun, reload_modified
    )
    fresh = stage(fresh, "files")
    todo = cap_files(fresh, cap, newest_only=mode is Mode.MTD)
    files = [(r["full_path"], r["filename"]) for r in todo.orderBy("full_path").collect()]
    if not files:
        return []
    spec = RefreshSpec(
        ingest_type=mode, partition_column=table.partition_column, partition_value=partition_value or ctx.run_date
    )
    _load_files(spark, files, fmt, table, ctx, spec, transforms, events, read_options)
    done = fresh if mode is Mode.MTD else todo
    log.upsert(done.drop("full_path"), ["parent_path", "filename", "st_mtime"])
    unstage(fresh)
    return [path for path, _ in files]


def changed_files_job(
    spark: SparkSession,
    listing: DataFrame,
    log: WarehouseTable,
    table: WarehouseTable,
    ctx: RunContext,
    fmt: str,
    spec: RefreshSpec = RefreshSpec(ingest_type=Mode.CDC),
    force_rerun: bool = False,
    transforms: Transform | Sequence[Transform] | None = None,
    events: EventLog | None = None,
    read_options: dict | None = None,
    is_logging: bool = True,
) -> int:
    """Load the listed files together if the content of any of them changed, or when forced.

    Serves a single file and a whole glob alike: one listing row or many.
    """
    hashed = stage(
        hash_files(listing).withColumnRenamed("filename", "file_name"), "hashes"
    )
    seen = log.read() if log.exists else hashed.where(F.lit(False))
    if not force_rerun and changed_content(hashed, seen).where("is_changed").isEmpty():
        return 0
    rows = hashed.select(F.concat_ws("/", "parent_path", "file_name"), "file_name").orderBy("file_name").collect()
    files = [(path, name) for path, name in rows]
    if not files:
        return 0
    n = _load_files(spark, files, fmt, table, ctx, spec, transforms, events, read_options)
    if is_logging:
        log.upsert(hashed.drop("parent_path"), ["file_name", "hash_check_sum"], ["st_mtime"])
    unstage(hashed)
    return n


def export_job(
    spark: SparkSession, source: Source, path: str, ctx: RunContext, events: EventLog | None = None, **options
) -> int:
    """Query to delimited text at the target."""
    return logged(
        events, ctx, path, source.tables(), source.fmt, None,
        lambda: write_delimited(source.read(spark), path, **options),
    )


def backup_job(
    spark: SparkSession, source: Source, path: str, column: str, lower: str | None = None, upper: str | None = None
) -> int:
    """Table to one parquet directory per month; bounds are pushed into the source."""
    df = source.read(spark)
    if lower:
        df = df.where(F.col(column) >= F.lit(lower).cast("timestamp_ntz"))
    if upper:
        df = df.where(F.col(column) < F.lit(upper).cast("timestamp_ntz"))
    return backup_by_month(df, column, path)


def mirror_job(
    spark: SparkSession,
    source: Source,
    table: WarehouseTable,
    ctx: RunContext,
    spec: RefreshSpec = RefreshSpec(refresh_type=Mode.FULL),
    events: EventLog | None = None,
) -> int:
    """Copy a table with audit columns."""
    return transform_job(spark, source, table, ctx, spec, events=events)


def history_job(
    spark: SparkSession,
    source: Source,
    table: WarehouseTable,
    ctx: RunContext,
    transforms: Transform | Sequence[Transform] | None = None,
    events: EventLog | None = None,
    run_dates: DataFrame | None = None,
) -> int:
    """Bulk history: every month in the source replaces that month of the table, in one job.

    ``run_dates`` (see ``resolve_run_dates``) names months to replace even if the source is
    empty there.
    """
    if table.interval != "MONTHLY" or not table.partition_column:
        raise ValueError("history needs a table in monthly slices")

    def work() -> int:
        df = normalize_columns(source.read(spark))
        steps = [*_steps(transforms), lambda d: add_audit(d, ctx)]
        ready = reconcile(df, table.schema if table.exists else None, steps, metadata=table)
        due = [as_datetime(r[0]).date() for r in run_dates.collect()] if run_dates is not None else []
        return table.refresh_slices(ready, due)

    return logged(events, ctx, table.name, source.tables(), source.fmt, "HISTORY", work)


def two_step_job(
    spark: SparkSession,
    source: Source,
    staging: WarehouseTable,
    build: Transform,
    table: WarehouseTable,
    ctx: RunContext,
    events: EventLog | None = None,
) -> int:
    """Heavy part into a staging table (full), then the run date's month of the target from it."""
    transform_job(spark, source, staging, ctx, RefreshSpec(refresh_type=Mode.FULL), events=events)
    second = Source(lambda: build(staging.read().drop("BATCH_JOB_ID", "EDW_UPDATE_DTTM")), "memory")
    return transform_job(spark, second, table, ctx, events=events)


def run_log_job(
    runs: DataFrame, table: WarehouseTable, ctx: RunContext, run: str, start: str, end: str, date_column: str
) -> int:
    """Run rows with the bounds of their run, replacing the days they cover."""
    rows = group_bounds(runs, [run], start, end)
    spec = RefreshSpec(refresh_type=Mode.PARTITION_N_DAYS, partition_column=date_column)
    return load_frame(rows, table, ctx, spec)


def one_slash(path) -> Column:
    """A path whose scheme is followed by one slash, as listings and readers write it differently."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def logged_files_job(
    spark: SparkSession,
    logged_listing: DataFrame,
    success: DataFrame,
    table: WarehouseTable,
    ctx: RunContext,
    fmt: str,
    read_options: dict | None = None,
) -> DataFrame:
    """Files another process logged but nobody loaded: load them by CDC and return their log rows.

    The rows carry the file size and the number of lines loaded.
    """
    todo = stage(unlogged(logged_listing, success), "files")
    files = [
        (r[0], r[1])
        for r in todo.select(F.concat_ws("/", "parent_path", "filename"), "filename").orderBy("filename").collect()
    ]
    if not files:
        return todo.withColumn("n_lines", F.lit(0).cast("bigint"))
    _load_files(spark, files, fmt, table, ctx, RefreshSpec(ingest_type=Mode.CDC), None, None, read_options)
    # Files of one name in several folders are told apart by their paths.
    loaded = read_files(spark, [path for path, _ in files], fmt, with_path=True, **(read_options or {}))
    lines = loaded.groupBy(one_slash("FILE_PATH").alias("_path")).agg(F.count("*").alias("n_lines"))
    own = todo.withColumn("_path", one_slash(F.concat_ws("/", "parent_path", "filename")))
    return own.join(lines, "_path", "left").drop("_path").withColumn("n_lines", F.coalesce("n_lines", F.lit(0).cast("bigint")))
