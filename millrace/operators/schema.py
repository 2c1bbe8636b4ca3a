"""Schema reconciliation between a batch and its sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_LIMIT = 1000  # fixed value: width of a text column in the sink

Transform = Callable[..., DataFrame]


@dataclass(frozen=True)
class SchemaPolicy:
    """How a batch is fitted to an existing sink."""

    evolve: bool = False  # add new columns to the sink instead of dropping them
    strict: bool = True  # a value that does not fit the sink type fails the job
    check_nulls: bool = True


def sink_type(dtype: T.DataType) -> T.DataType:
    """Type of a sink column that is added for a batch column."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.IntegerType()
    if isinstance(dtype, (T.LongType, T.FloatType)):
        return dtype
    if isinstance(dtype, (T.DoubleType, T.DecimalType)):
        return T.DecimalType(30, 8)
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return T.StringType()
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return T.TimestampNTZType()
    if isinstance(dtype, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return T.StringType()
    return dtype


def _lower(names: Sequence[str]) -> set[str]:
    return {n.lower() for n in names}


def add_missing_columns(df: DataFrame, sink: T.StructType) -> DataFrame:
    """Sink columns the batch lacks, as typed NULLs."""
    have = _lower(df.columns)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in sink.fields if f.name.lower() not in have}
    return df.withColumns(missing) if missing else df


def ignore_new_columns(df: DataFrame, sink: T.StructType) -> DataFrame:
    """Without the batch columns the sink lacks."""
    known = _lower(sink.fieldNames())
    return df.select([c for c in df.columns if c.lower() in known])


def new_fields(df: DataFrame, sink: T.StructType) -> list[T.StructField]:
    """Nullable sink fields for the batch columns the sink lacks."""
    known = _lower(sink.fieldNames())
    return [
        T.StructField(f.name, sink_type(f.dataType), True)
        for f in df.schema.fields
        if f.name.lower() not in known
    ]


def evolve_schema(df: DataFrame, sink: T.StructType) -> T.StructType:
    """Sink schema with the new batch columns added."""
    return T.StructType(sink.fields + new_fields(df, sink))


def evolve(target: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Target and batch brought to the evolved schema; old rows get NULL."""
    schema = evolve_schema(batch, target.schema)
    return fit(target, schema), fit(batch, schema)


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs per column that must not have any: one aggregate over the batch."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n_nulls")


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail on a NULL in any of ``columns`` while the rows stream by: no extra pass."""
    checked = {
        c: F.coalesce(F.col(c), F.raise_error(F.lit(f"NULL in column {c}")).cast(df.schema[c].dataType))
        for c in columns
    }
    return df.withColumns(checked) if checked else df


def _cast(column: str, dtype: T.DataType, strict: bool) -> Column:
    return F.col(column).cast(dtype) if strict else F.col(column).try_cast(dtype)


def sync_types(df: DataFrame, sink: T.StructType, strict: bool = True) -> DataFrame:
    """Cast every sink column to the sink type; extra batch columns pass through.

    Strict: a value that does not fit fails the job. Lenient: it becomes NULL
    (count them with :func:`cast_losses`).
    """
    have = {f.name.lower(): f for f in df.schema.fields}
    absent = [f.name for f in sink.fields if f.name.lower() not in have]
    if absent:
        raise ValueError(f"sink columns missing in the batch: {absent}")
    changed = {
        have[f.name.lower()].name: _cast(have[f.name.lower()].name, f.dataType, strict)
        for f in sink.fields
        if have[f.name.lower()].dataType != f.dataType
    }
    return df.withColumns(changed) if changed else df


def cast_losses(df: DataFrame, sink: T.StructType) -> DataFrame:
    """Values per column that a lenient cast to the sink type would turn into NULL."""
    names = [f.name for f in sink.fields]
    lost = [
        F.count_if(F.col(f.name).isNotNull() & _cast(f.name, f.dataType, False).isNull()).alias(f.name)
        for f in sink.fields
    ]
    return df.agg(*lost).unpivot([], names, "column_name", "n_lost")


def order_columns(df: DataFrame, sink: T.StructType) -> DataFrame:
    """Sink columns in sink order, then the others."""
    known = _lower(sink.fieldNames())
    return df.select(*sink.fieldNames(), *[c for c in df.columns if c.lower() not in known])


def fit(df: DataFrame, sink: T.StructType, strict: bool = True) -> DataFrame:
    """Exactly the sink's columns, types and order."""
    full = add_missing_columns(df, sink)
    return sync_types(full, sink, strict).select(sink.fieldNames())


def apply_transforms(
    df: DataFrame, transforms: Transform | Sequence[Transform] | None, metadata: object = None
) -> DataFrame:
    """One callable or a list of them, in order.

    A callable with a true ``is_request_metadata`` also gets the sink metadata and the session.
    """
    steps = [transforms] if callable(transforms) else list(transforms or [])
    for step in steps:
        if getattr(step, "is_request_metadata", False):
            df = df.transform(step, metadata=metadata, spark=df.sparkSession)
        else:
            df = df.transform(step)
    return df


def reconcile(
    df: DataFrame,
    sink: T.StructType | None,
    transforms: Transform | Sequence[Transform] | None = None,
    policy: SchemaPolicy = SchemaPolicy(),
    replaces_all: bool = False,
    metadata: object = None,
) -> DataFrame:
    """Missing columns, new columns, NULL check, user transforms, type sync, in that order.

    ``sink`` is None when the sink is no table or does not exist yet. User transforms run
    after new columns are dropped, so what they add survives. A full refresh keeps new columns.
    """
    if sink is None:
        return apply_transforms(df, transforms, metadata)
    df = add_missing_columns(df, sink)
    if not policy.evolve and not replaces_all:
        df = ignore_new_columns(df, sink)
    if policy.check_nulls:
        df = require_not_null(df, [f.name for f in sink.fields if not f.nullable])
    df = apply_transforms(df, transforms, metadata)
    return order_columns(sync_types(df, sink, policy.strict), sink)


def width_profile(df: DataFrame, limit: int = TEXT_LIMIT) -> DataFrame:
    """Longest value of every text column, and whether it exceeds ``limit``: one pass."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    widths = df.agg(*[F.max(F.length(c)).alias(c) for c in names])
    profile = widths.unpivot([], names, "column_name", "max_length")
    return profile.withColumn("over_limit", F.coalesce(F.col("max_length") > limit, F.lit(False)))


def require_width(df: DataFrame, limit: int = TEXT_LIMIT) -> DataFrame:
    """Fail on a text longer than the sink column while the rows stream by."""
    checked = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            message = F.lit(f"text longer than {limit} in column {f.name}")
            fits = F.length(f.name) <= limit
            checked[f.name] = F.when(F.col(f.name).isNull() | fits, F.col(f.name)).otherwise(
                F.raise_error(message).cast("string")
            )
    return df.withColumns(checked) if checked else df


def column_metadata(df: DataFrame) -> DataFrame:
    """Column id, name, type and nullability as a DataFrame."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "COLUMN_ID int, COL_NAME string, DATA_TYPE string, IS_NULLABLE boolean"
    )
