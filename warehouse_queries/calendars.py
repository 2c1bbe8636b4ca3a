"""Run dates, partitions, dated paths, working days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from millrace.operators import calendar as K
from warehouse_queries.registry import query, table

FIRST_LAST = "fl AS (SELECT o_custkey, min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders GROUP BY 1)"


def first_last(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e")
    )


def _text(df, column="run_date"):
    return df.select("o_custkey", F.col(column).cast("string").alias(column))


def _months_sql(start: str, end: str, step: int, keep: str) -> str:
    """Month steps from the date before, as a recursive query."""
    return f"""
    WITH RECURSIVE {FIRST_LAST},
    r AS (SELECT o_custkey, CAST({start} + INTERVAL 1 DAY AS TIMESTAMP) AS x, {end} AS stop FROM fl
          UNION ALL SELECT o_custkey, CAST(x + INTERVAL ({step}) MONTH AS TIMESTAMP), stop FROM r
          WHERE x + INTERVAL ({step}) MONTH - INTERVAL 1 DAY {keep} stop)
    SELECT o_custkey, strftime(x - INTERVAL 1 DAY, '%Y-%m-%d') AS run_date FROM r
    """


@query("run_date_spine", _months_sql("s", "e", 1, "<="))
def run_date_spine(spark, d):
    return _text(K.run_dates(first_last(spark, d), "s", "e", "monthly"))


@query("run_date_spine_desc", _months_sql("e", "s", -2, ">="))
def run_date_spine_desc(spark, d):
    """Newest first, every second month. A customer with one order date counts as ascending."""
    return _text(K.run_dates(first_last(spark, d), "e", "s", "monthly", 2))


@query(
    "run_date_spine_weekly",
    f"""
    WITH {FIRST_LAST}
    SELECT o_custkey, strftime(unnest(generate_series(s, e, INTERVAL 14 DAY)), '%Y-%m-%d') AS run_date FROM fl
    """,
)
def run_date_spine_weekly(spark, d):
    return _text(K.run_dates(first_last(spark, d), "s", "e", "weeks", 2))


@query(
    "partition_boundaries",
    f"""
    WITH {FIRST_LAST}
    SELECT o_custkey, strftime(unnest(generate_series(date_trunc('month', s), e, INTERVAL 1 MONTH)), '%Y-%m-%d') AS boundary FROM fl
    """,
)
def partition_boundaries(spark, d):
    ranges = first_last(spark, d).select("o_custkey", F.trunc("s", "MM").alias("s"), F.to_date("e").alias("e"))
    boundaries = ranges.select("o_custkey", F.explode(K.partition_boundaries("s", "e")).alias("boundary"))
    return _text(boundaries, "boundary")


def _number_sql(column: str, step: str, start: str, end: str) -> str:
    return f"""
    WITH b AS (SELECT unnest(generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL {step})) AS b),
    days AS (SELECT o_orderdate, (SELECT count(*) FROM b WHERE b.b <= o_orderdate) + 1 AS n
             FROM (SELECT DISTINCT o_orderdate FROM orders))
    SELECT o_orderkey, CAST(n AS INTEGER) AS {column} FROM orders JOIN days USING (o_orderdate)
    """


@query("partition_number", _number_sql("partition_number", "1 MONTH", "1996-01-01", "2000-12-01"))
def partition_number(spark, d):
    """Dates before the first and after the last boundary fall in the outer partitions."""
    number = K.partition_number("o_orderdate", date(1996, 1, 1), date(2000, 12, 1))
    return table(spark, d, "orders").select("o_orderkey", number.alias("partition_number"))


@query("partition_number_weekly", _number_sql("partition_number", "7 DAY", "1996-01-01", "2000-12-01"))
def partition_number_weekly(spark, d):
    number = K.partition_number("o_orderdate", date(1996, 1, 1), date(2000, 12, 1), "WEEKLY")
    return table(spark, d, "orders").select("o_orderkey", number.alias("partition_number"))


@query("partition_number_yearly", _number_sql("partition_number", "1 YEAR", "1996-02-15", "2000-12-01"))
def partition_number_yearly(spark, d):
    number = K.partition_number("o_orderdate", date(1996, 2, 15), date(2000, 12, 1), "YEARLY")
    return table(spark, d, "orders").select("o_orderkey", number.alias("partition_number"))


@query(
    "partition_number_integer",
    "SELECT o_orderkey, CAST(least(greatest(o_custkey // 100, 0), 9) + 2 AS INTEGER) AS partition_number FROM orders",
)
def partition_number_integer(spark, d):
    number = K.partition_number("o_custkey", 0, 900, 100)
    return table(spark, d, "orders").select("o_orderkey", number.alias("partition_number"))


@query(
    "slice_start",
    """
    SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_slice,
           strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS year_slice,
           CAST(CAST(o_orderdate AS DATE) - ((date_diff('day', DATE '2015-01-01', CAST(o_orderdate AS DATE)) % 7 + 7) % 7)::INTEGER AS VARCHAR) AS week_slice
    FROM orders
    """,
)
def slice_start(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        K.slice_start("o_orderdate").cast("string").alias("month_slice"),
        K.slice_start("o_orderdate", "YEARLY").cast("string").alias("year_slice"),
        K.slice_start("o_orderdate", "WEEKLY").cast("string").alias("week_slice"),
    )


@query(
    "dated_paths",
    f"""
    WITH {FIRST_LAST}
    SELECT o_custkey, array_to_string(list_transform(generate_series(date_trunc('month', s), e, INTERVAL 1 MONTH),
           lambda x: '/lake/sales/' || strftime(x, '%Y/%m/%d') || '/'), ',') AS paths FROM fl
    """,
)
def dated_paths(spark, d):
    ranges = first_last(spark, d)
    return ranges.select("o_custkey", K.dated_paths("/lake/sales/", F.trunc("s", "MM"), "e", "months").alias("paths"))


_FREE = ", ".join(f"DATE '{day}'" for day, _ in K.HOLIDAYS)


@query(
    "working_days",
    f"""
    SELECT event_id, ts + INTERVAL 100 DAY AS ts FROM events
    WHERE CAST(ts + INTERVAL 100 DAY AS DATE) NOT IN ({_FREE})
    """,
)
def working_days(spark, d):
    """January events moved to April 2024, when there are holidays."""
    moved = table(spark, d, "events").select("event_id", (F.col("ts") + F.expr("INTERVAL 100 DAY")).alias("ts"))
    return K.working_days(moved, "ts", K.holidays(spark))
