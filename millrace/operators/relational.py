"""Aggregates, joins, windows, sorts and set operations users compose jobs from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.dates import month_start
from millrace.operators.joins import join_groups


def money_sum(value: Column, scale: int = 8) -> Column:
    """Exact sum of an amount with up to ``scale`` decimals, whatever the summing order.

    Amounts are summed as whole units of the last decimal. High and low bits go in two long
    sums, which is twice as fast as a decimal sum and cannot overflow below some trillion rows.
    An amount of more than 18 digits in these units is an error, never cut, and so is one with more
    decimals; the noise of computed doubles (some units in their last place) is none.
    """
    exact = value * 10**scale
    whole = F.rint(exact)
    finer = F.abs(exact - whole) > 0.001 + F.abs(whole) * 1e-15
    units = F.when(finer, F.raise_error(F.concat(F.lit(f"more than {scale} decimals: "), value.cast("string")))).otherwise(whole).cast("bigint")
    high = F.sum(F.shiftright(units, 20)).cast("decimal(38,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << 20) - 1)))
    return (high * (1 << 20) + low).cast("double") / 10**scale


def monthly_totals(
    df: DataFrame, time_column: str, keys: Sequence[str], sums: Mapping[str, Column], lower: str, upper: str
) -> DataFrame:
    """Sums per month and keys, for times between ``lower`` and ``upper`` (both inclusive)."""
    stamp = F.col(time_column)
    chosen = df.where(stamp.between(F.lit(lower).cast("timestamp_ntz"), F.lit(upper).cast("timestamp_ntz")))
    month = month_start(time_column).cast("timestamp_ntz").alias("month")
    return chosen.groupBy(month, *keys).agg(*[money_sum(c).alias(n) for n, c in sums.items()])


def group_bounds(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Each row with the least start and the greatest end of its group.

    An aggregate joined back instead of a window: the group is pre-aggregated in every task
    and a hot key is split by the skew join, while a window would hold it in one task.
    """
    bounds = df.groupBy(*keys).agg(F.min(start).alias("group_start"), F.max(end).alias("group_end"))
    return join_groups(df, bounds, keys)


def text_lists(details: DataFrame, keys: Sequence[str], text: str, name: str, separator: str = ",") -> DataFrame:
    """The texts of each group in order (of bytes), as one text.

    Repeated texts are counted first, in every task before the shuffle. What is left is ranged by text
    and then key, so a hot group and a hot text both lie in many tasks. Each task joins its range of a
    group to one piece, and the pieces are put together in the order of the ranges: no task holds a
    group's rows, only the text that is asked for. A group of NULL texts only has an empty list.
    """
    once = details.groupBy(*keys, F.col(text).alias("_text")).agg(F.count("*").alias("_n"))
    ranged = once.where("_text IS NOT NULL").repartitionByRange("_text", *keys)
    in_order = F.array_sort(F.collect_list(F.struct("_text", F.col("_n").cast("int").alias("_n"))))
    listed = F.flatten(F.transform(in_order, lambda t: F.array_repeat(t["_text"], t["_n"])))
    # Partitions stay ranges in ascending order, also where AQE merges neighbours.
    pieces = ranged.groupBy(*keys, F.spark_partition_id().alias("_range")).agg(F.array_join(listed, separator).alias("_piece"))
    without = once.where("_text IS NULL").select(*keys, F.lit(-1).alias("_range"), F.lit(None).cast("string").alias("_piece"))
    parts = F.array_sort(F.collect_list(F.struct("_range", "_piece")))
    joined = F.array_join(F.transform(parts, lambda p: p["_piece"]), separator)
    return pieces.unionByName(without).groupBy(*keys).agg(joined.alias(name))


def join_aggregate(
    left: DataFrame, details: DataFrame, keys: Sequence[str], text: str, name: str, separator: str = ","
) -> DataFrame:
    """Left join to ``details`` grouped by ``keys``, their texts listed by :func:`text_lists`."""
    return join_groups(left, text_lists(details, keys, text, name, separator), keys)


def lookup(left: DataFrame, required: DataFrame, optional: DataFrame, on: str, optional_on: str) -> DataFrame:
    """Inner join to ``required``, then left join to ``optional``."""
    return left.join(required, on, "inner").join(optional, optional_on, "left")


def top_with_total(df: DataFrame, name: str, metric: str, n: int, total_label: str = "ALL") -> DataFrame:
    """The ``n`` greatest rows by ``metric`` and one total row on top."""
    total = df.agg(F.sum(metric).alias(metric)).select(
        F.lit(total_label).alias(name), metric, F.lit(1).alias("priority")
    )
    rows = df.select(F.col(name).cast("string").alias(name), metric, F.lit(0).alias("priority"))
    order = [F.desc("priority"), F.desc(metric), F.asc(name)]
    top = rows.orderBy(*order[1:]).limit(n)
    return total.unionByName(top).orderBy(*order).limit(n + 1)


def first_n(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def _common_type(types: Sequence[T.DataType]) -> T.DataType:
    distinct = list(dict.fromkeys(types))
    if len(distinct) == 1:
        return distinct[0]
    solid = [t for t in distinct if not isinstance(t, T.NullType)]
    if len(solid) == 1:
        return solid[0]
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if all(isinstance(t, whole) for t in solid):
        return T.LongType()
    if all(isinstance(t, (*whole, T.FloatType, T.DoubleType)) for t in solid):
        return T.DoubleType()
    return T.StringType()


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union with missing columns as NULL. Types are aligned first.

    A column that is text in one frame and a number in another becomes text.
    """
    kinds: dict[str, list[T.DataType]] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds.setdefault(f.name, []).append(f.dataType)
    common = {name: _common_type(found) for name, found in kinds.items()}

    def align(df: DataFrame) -> DataFrame:
        casts = {f.name: F.col(f.name).cast(common[f.name]) for f in df.schema.fields if f.dataType != common[f.name]}
        return df.withColumns(casts) if casts else df

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [align(df) for df in frames])


def difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose keys do not occur in ``right``."""
    return left.join(right.select(*keys), list(keys), "left_anti")


def intersection(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys that occur on both sides."""
    return left.select(*keys).intersect(right.select(*keys))


def drop_all_null(df: DataFrame) -> DataFrame:
    """Without the rows in which every column is NULL."""
    return df.na.drop("all")


def cast_columns(df: DataFrame, types: Mapping[str, str], lenient: bool = False) -> DataFrame:
    """Columns cast to other types by name."""
    return df.withColumns(
        {n: F.col(n).try_cast(t) if lenient else F.col(n).cast(t) for n, t in types.items()}
    )


def rename_drop(df: DataFrame, renames: Mapping[str, str] | None = None, drops: Sequence[str] = ()) -> DataFrame:
    """Renamed columns, without the dropped ones."""
    return df.withColumnsRenamed(dict(renames or {})).drop(*drops)
