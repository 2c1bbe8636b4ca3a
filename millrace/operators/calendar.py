"""Run dates, partition boundaries and numbers, dated paths, working days."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Step units as (kind, size).
UNITS = {
    "daily": ("day", 1),
    "days": ("day", 1),
    "weeks": ("day", 7),
    "monthly": ("month", 1),
    "months": ("month", 1),
    "years": ("month", 12),
}
# Partition intervals, and the default range of boundaries.
INTERVALS = {"DAILY": ("day", 1), "WEEKLY": ("day", 7), "MONTHLY": ("month", 1), "YEARLY": ("month", 12)}
RANGE_START = date(2015, 1, 1)
RANGE_END = date(2050, 12, 1)

# The maintained list of days that do not count as working days.
HOLIDAYS = (
    ("2024-04-18", "Hung King Day"),
    ("2024-04-30", "Victory Day"),
    ("2024-05-01", "Labor Day"),
    ("2024-09-02", "Le 2-9"),
    ("2024-09-03", "Le 2-9"),
    ("2025-01-01", "Solar New Years Day"),
    ("2025-01-27", "Lunar New Year"),
    ("2025-01-28", "Lunar New Year"),
    ("2025-01-29", "Lunar New Year"),
    ("2025-01-30", "Lunar New Year"),
    ("2025-01-31", "Lunar New Year"),
    ("2025-02-01", "Lunar New Year"),
    ("2025-04-07", "Hung King Day"),
    ("2025-04-30", "Victory Day"),
    ("2025-05-01", "Labor Day"),
    ("2025-09-01", "Independence Day"),
    ("2025-09-02", "Independence Day"),
)


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _month_steps(start: Column, count: Column, step: Column) -> Column:
    """``start`` and ``count`` further dates, each a month step from the one before.

    Stepping from the previous date keeps a day that a short month cut (01-30, 02-28, 03-28).
    """
    return F.aggregate(
        F.sequence(F.lit(0), count),
        F.array(start),
        lambda acc, i: F.when(i == 0, acc).otherwise(
            F.concat(acc, F.array(F.add_months(F.element_at(acc, -1), step)))
        ),
    )


def _month_spine(start: Column, end: Column, size: int) -> Column:
    """Dates from ``start`` to ``end`` in steps of ``size`` months, descending if ``start`` is later."""
    down = start > end
    step = F.when(down, -size).otherwise(size)
    # No month cuts a day up to 28, so a plain sequence gives the same dates.
    plain = F.sequence(start, end, F.make_ym_interval(F.lit(0), step))
    count = F.ceil(F.abs(F.months_between(start, end)) / size).cast("int") + 1
    stepped = F.filter(_month_steps(start, count, step), lambda d: F.when(down, d >= end).otherwise(d <= end))
    return F.when(F.dayofmonth(start) <= 28, plain).otherwise(stepped)


def _ascending(start: Column, end: Column, dates: Column) -> Column:
    """``dates``, or no date at all if ``start`` is after ``end``."""
    return F.when(start <= end, dates).when(start > end, F.array().cast("array<date>"))


def date_spine(start: Column | str, end: Column | str, mode: str = "daily", interval: int = 1) -> Column:
    """Array of dates from ``start`` to ``end``, both inclusive, descending if ``start`` is later.

    Month steps are taken one day late and moved back, so a month end stays a month end.
    """
    start, end = _c(start).cast("date"), _c(end).cast("date")
    kind, size = UNITS[mode]
    if kind == "day":
        step = F.when(start > end, -size * interval).otherwise(size * interval)
        return F.sequence(start, end, F.make_dt_interval(step))
    late = _month_spine(F.date_add(start, 1), F.date_add(end, 1), size * interval)
    return F.transform(late, lambda d: F.date_sub(d, 1))


def run_dates(
    df: DataFrame, start: Column | str, end: Column | str, mode: str = "daily", interval: int = 1
) -> DataFrame:
    """One row per run date for every input row."""
    return df.withColumn("run_date", F.explode(date_spine(start, end, mode, interval)))


def resolve_run_dates(
    spark: SparkSession, params: dict | None = None, logical_date: date | str | None = None
) -> DataFrame:
    """Run dates (text) of a run parameter: a list, one date, or a start/end dict.

    Keys ``RUN_DATES`` or ``run_dates``. Without a parameter the logical date is the only one.
    """
    params = params or {}
    value = params.get("RUN_DATES", params.get("run_dates"))
    if isinstance(value, dict):
        for key in ("start_date", "end_date"):
            if not value.get(key):
                raise ValueError(f"run_dates needs {key}")
        one = spark.range(1).select(
            F.lit(value["start_date"]).cast("date").alias("s"), F.lit(value["end_date"]).cast("date").alias("e")
        )
        spine = date_spine("s", "e", value.get("mode", "daily"), int(value.get("interval", 1)))
        return one.select(F.explode(spine.cast("array<string>")).alias("run_date"))
    if value:
        dates = list(value) if isinstance(value, (list, tuple)) else [value]
    elif logical_date is not None:
        dates = [logical_date]
    else:
        raise ValueError("neither run dates nor a logical date given")
    return spark.createDataFrame([(str(d)[:10],) for d in dates], "run_date string")


def partition_boundaries(
    start: Column | str | date = RANGE_START, end: Column | str | date = RANGE_END, interval: str | int = "MONTHLY"
) -> Column:
    """Array of range boundaries from ``start`` to ``end``; integers step by an integer interval."""
    start = F.lit(start) if isinstance(start, (date, int)) else _c(start)
    end = F.lit(end) if isinstance(end, (date, int)) else _c(end)
    if isinstance(interval, int):
        return F.sequence(start, end, F.lit(interval))
    if interval not in INTERVALS:
        raise NotImplementedError(f"{interval} is not supported")
    kind, size = INTERVALS[interval]
    start, end = start.cast("date"), end.cast("date")
    days = F.sequence(start, end, F.make_dt_interval(F.lit(size)))
    return _ascending(start, end, days if kind == "day" else _month_spine(start, end, size))


def partition_number(
    col: Column | str,
    start: date | int = RANGE_START,
    end: date | int = RANGE_END,
    interval: str | int = "MONTHLY",
) -> Column:
    """Partition a value falls in: boundaries at or below it, plus one; NULL is in the first.

    Plain arithmetic, so it runs inside the scan stage and never joins a boundary table.
    """
    value = _c(col)
    if isinstance(interval, int):
        below = F.floor((value - start) / interval) + 1
        total = (end - start) // interval + 1
    else:
        kind, size = INTERVALS[interval]
        if kind == "day":
            below = F.floor(F.datediff(value, F.lit(start)) / size) + 1
            total = (end - start).days // size + 1
        else:
            if start.day > 28:
                raise ValueError("month boundaries must start on day 1 to 28")
            months = (F.year(value) - start.year) * 12 + F.month(value) - start.month
            months = months - F.when(F.dayofmonth(value) < start.day, 1).otherwise(0)
            below = F.floor(months / size) + 1
            span = (end.year - start.year) * 12 + end.month - start.month - (end.day < start.day)
            total = span // size + 1
    clamped = F.least(F.greatest(below, F.lit(0)), F.lit(total))
    return F.coalesce(clamped, F.lit(0)).cast("int") + 1


SLICE_INTERVALS = ("DAILY", "WEEKLY", "MONTHLY", "YEARLY")


def slice_interval(interval: str) -> str:
    """``interval`` if tables can be sliced by it, else an error."""
    if interval not in SLICE_INTERVALS:
        raise ValueError(f"{interval} is no slice interval; use one of {', '.join(SLICE_INTERVALS)}")
    return interval


def slice_start(col: Column | str, interval: str = "MONTHLY", start: date = RANGE_START) -> Column:
    """First day of the slice a value belongs to; the directory key of partitioned tables."""
    value = _c(col)
    if slice_interval(interval) == "DAILY":
        return value.cast("date")
    if interval == "WEEKLY":
        days = F.datediff(value, F.lit(start))
        return F.date_sub(value.cast("date"), F.pmod(days, F.lit(7)))
    return F.trunc(value, "MM" if interval == "MONTHLY" else "YEAR")


def slice_start_of(value: datetime, interval: str = "MONTHLY", start: date = RANGE_START) -> date:
    """:func:`slice_start` of one known value."""
    day = value.date()
    if slice_interval(interval) == "DAILY":
        return day
    if interval == "WEEKLY":
        return date.fromordinal(day.toordinal() - (day - start).days % 7)
    return day.replace(day=1) if interval == "MONTHLY" else day.replace(month=1, day=1)


def dated_path_list(
    prefix: str, start: Column | str, end: Column | str, mode: str = "days", pattern: str = "yyyy/MM/dd"
) -> Column:
    """Array of ``prefix/yyyy/MM/dd/`` paths, one per step from ``start`` to ``end``."""
    start, end = _c(start).cast("date"), _c(end).cast("date")
    kind, size = UNITS[mode]
    days = F.sequence(start, end, F.make_dt_interval(F.lit(size)))
    dates = _ascending(start, end, days if kind == "day" else _month_spine(start, end, size))
    head = prefix.rstrip("/") + "/"
    return F.transform(dates, lambda d: F.concat(F.lit(head), F.date_format(d, pattern), F.lit("/")))


def dated_paths(prefix: str, start: Column | str, end: Column | str, mode: str = "days") -> Column:
    """The dated paths as one comma-separated text."""
    return F.array_join(dated_path_list(prefix, start, end, mode), ",")


def holidays(spark: SparkSession, days: Sequence[tuple[str, str]] = HOLIDAYS) -> DataFrame:
    """Days to leave out, as an inline table."""
    rows = ", ".join(f"(1, '{day}', '{remark}')" for day, remark in days)
    return spark.sql(
        "SELECT CAST(c AS INT) AS CONFIRMED_DELETED_DATE, CAST(d AS TIMESTAMP_NTZ) AS DELETED_DATE, "
        f"r AS CONFIRMED_DELETED_REMARK FROM VALUES {rows} AS t(c, d, r)"
    )


def working_days(df: DataFrame, column: str, free_days: DataFrame) -> DataFrame:
    """Rows whose day is not in ``free_days.DELETED_DATE``."""
    free = free_days.where("CONFIRMED_DELETED_DATE = 1").select(F.to_date("DELETED_DATE").alias("_free"))
    return df.join(free, F.col(column).cast("date") == F.col("_free"), "left_anti")
