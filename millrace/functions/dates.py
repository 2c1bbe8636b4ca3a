"""Dates: standardising, pattern parsing, time zones, formatting, arithmetic."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIAL_BASE = "1899-12-30"  # fixed value: day 0 of workbook serial dates
SERIAL_FIRST = -693594  # fixed value: last serial before 0001-01-01
SERIAL_END = 2958466  # fixed value: first serial after 9999-12-31

# Strptime directives as (one digit or more, fixed width) Spark letters.
STRPTIME = {
    "Y": ("yyyy", "yyyy"),
    "y": ("yy", "yy"),
    "m": ("M", "MM"),
    "d": ("d", "dd"),
    "H": ("H", "HH"),
    "I": ("h", "hh"),
    "M": ("m", "mm"),
    "S": ("s", "ss"),
    "f": ("SSSSSS", "SSSSSS"),
    "p": ("a", "a"),
    "b": ("MMM", "MMM"),
    "B": ("MMMM", "MMMM"),
    "j": ("D", "DDD"),
}


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def spark_pattern(strptime_pattern: str) -> str:
    """A strptime pattern as a Spark datetime pattern.

    Directives that touch each other need fixed widths; the others accept one digit.
    """
    tokens = re.findall(r"%.|[^%]+", strptime_pattern)
    out = []
    for i, token in enumerate(tokens):
        if token[0] == "%" and token != "%%":
            if token[1] not in STRPTIME:
                raise ValueError(f"directive {token} is not supported")
            touches = any(
                0 <= j < len(tokens) and tokens[j][0] == "%" and tokens[j] != "%%"
                for j in (i - 1, i + 1)
            )
            out.append(STRPTIME[token[1]][touches])
        else:
            text = "%" if token == "%%" else token
            out.append(re.sub(r"[A-Za-z']+|[\[\]{}#]", lambda m: "'" + m.group().replace("'", "''") + "'", text))
    return "".join(out)


def serial_to_date(col: Column | str) -> Column:
    """Workbook serial number (whole days) to a date."""
    return F.date_add(F.lit(SERIAL_BASE).cast("date"), _c(col).cast("int"))


def date_columns(schema: T.StructType) -> list[str]:
    """Columns the date standardiser picks by itself."""

    def by_name(name: str) -> bool:
        low = name.lower()
        return low.endswith("_dt") or "_dttm" in low or "date" in low

    return [
        f.name
        for f in schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
        or (isinstance(f.dataType, T.IntegerType) and by_name(f.name))
    ]


def standardize_dates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Timestamps to dates and integer serials to dates; other types stay as they are."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for name in columns or date_columns(df.schema):
        if isinstance(types[name], (T.TimestampType, T.TimestampNTZType)):
            changed[name] = F.col(name).cast("date")
        elif isinstance(types[name], T.IntegerType):
            changed[name] = serial_to_date(name)
    return df.withColumns(changed) if changed else df


def parse_date(col: Column | str, pattern: str, strict: bool = True) -> Column:
    """Text or integer to a day (as timestamp without zone).

    Blank or NULL gives NULL. A number below ``SERIAL_END`` is a workbook serial. Anything
    else must match ``pattern`` (strptime spelling); a misfit fails the job in strict mode
    and is NULL otherwise.
    """
    text = _c(col).cast("string")
    is_number = text.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
    number = F.when(is_number, text.try_cast("double"))
    day = F.coalesce(
        F.when((number > SERIAL_FIRST) & (number < SERIAL_END), serial_to_date(number)),
        F.try_to_date(text, spark_pattern(pattern)),
    )
    if strict:
        message = F.concat(F.lit(f"does not match {pattern}: "), text)
        day = F.coalesce(day, F.raise_error(message).cast("date"))
    return F.when(text.isNotNull() & (text != ""), day).cast("timestamp_ntz")


def parse_dates(
    df: DataFrame, columns: Sequence[str], pattern: str, strict: bool = True
) -> DataFrame:
    """:func:`parse_date` on the string and int columns among ``columns``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for name in columns:
        if isinstance(types[name], T.StringType):
            changed[name] = parse_date(name, pattern, strict)
        elif isinstance(types[name], T.IntegerType):
            changed[name] = parse_date(F.nullif(F.col(name), F.lit(0)), pattern, strict)
    return df.withColumns(changed) if changed else df


def parse_month_label(col: Column | str) -> Column:
    """``M1.2024`` to the first of that month, with native functions only."""
    digits = F.lpad(F.regexp_replace(_c(col), "M", ""), 7, "0")
    return F.try_to_date(digits, "MM.yyyy").cast("timestamp_ntz")


TEXT_MONTH_SQL = (
    "CAST(try_to_date(concat(right(translate({c}, '/\\\\-', '...'), 4), '-', "
    "substring(translate({c}, '/\\\\-', '...'), 2, "
    "greatest(instr(translate({c}, '/\\\\-', '...'), '.') - 2, 0)), '-01'), 'yyyy-M-dd') AS TIMESTAMP_NTZ)"
)


def text_month(col: Column | str) -> Column:
    """Month text such as ``M1/2024`` to the first of the month; misfits give NULL.

    Year = the last four characters, month = from the second character to the separator.
    """
    text = F.translate(_c(col), "/\\-", "...")
    length = F.greatest(F.instr(text, ".") - 2, F.lit(0))
    month = F.substring(text, F.lit(2), length)
    whole = F.concat(F.right(text, F.lit(4)), F.lit("-"), month, F.lit("-01"))
    return F.try_to_date(whole, "yyyy-M-dd").cast("timestamp_ntz")


def shift_zone(col: Column | str, from_zone: str = "Asia/Bangkok", to_zone: str = "UTC") -> Column:
    """Wall time in one zone to wall time in another."""
    return F.convert_timezone(F.lit(from_zone), F.lit(to_zone), _c(col).cast("timestamp_ntz"))


def format_in_zone(col: Column | str, from_zone: str = "UTC", to_zone: str = "Asia/Bangkok") -> Column:
    """``yyyy-MM-dd HH:mm:ss +hh`` in the target zone; missing gives empty text.

    The zone is printed as its offset (``+07``, or ``+0530`` when it has minutes).
    """
    utc = shift_zone(col, from_zone, "UTC")
    local = shift_zone(col, from_zone, to_zone)
    minutes = F.timestamp_diff("MINUTE", utc, local)
    size = F.abs(minutes)
    offset = F.concat(
        F.when(minutes < 0, "-").otherwise("+"),
        F.lpad((size / 60).cast("int").cast("string"), 2, "0"),
        F.when(size % 60 != 0, F.lpad((size % 60).cast("string"), 2, "0")).otherwise(""),
    )
    text = F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss"), F.lit(" "), offset)
    return F.coalesce(text, F.lit(""))


def epoch_seconds(col: Column | str) -> Column:
    """Seconds since 1970 to a UTC timestamp without zone, whatever the session zone is."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return zero + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _c(col))


def format_date(col: Column | str, is_text: bool = False) -> Column:
    """``yyyy-MM-dd``; a text column passes through."""
    return _c(col) if is_text else F.date_format(_c(col), "yyyy-MM-dd")


def format_date_path(col: Column | str) -> Column:
    """``yyyy/MM/dd`` of a date, a timestamp or ``yyyy-MM-dd`` text."""
    return F.date_format(_c(col).cast("date"), "yyyy/MM/dd")


def to_day(col: Column | str) -> Column:
    """``yyyy-MM-dd`` text to midnight of that day."""
    return F.to_date(_c(col), "yyyy-MM-dd").cast("timestamp_ntz")


def plus_days(col: Column | str, n: Column | int) -> Column:
    return _c(col) + F.make_dt_interval(F.lit(n) if isinstance(n, int) else n)


def plus_months(col: Column | str, n: Column | int) -> Column:
    return _c(col) + F.make_ym_interval(F.lit(0), F.lit(n) if isinstance(n, int) else n)


def duration_seconds(start: Column | str, end: Column | str) -> Column:
    """Second boundaries crossed between two times."""

    def whole(col: Column | str) -> Column:
        return F.date_trunc("second", _c(col))

    return F.timestamp_diff("SECOND", whole(start), whole(end))


def month_start(col: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_c(col), "MM")


def month_end(col: Column | str, offset: int = 0) -> Column:
    """Last day of the month ``offset`` months away."""
    return F.last_day(F.add_months(_c(col), offset))
