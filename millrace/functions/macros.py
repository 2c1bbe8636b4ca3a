"""Date macros as Spark SQL functions, for use inside query texts."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.functions.dates import TEXT_MONTH_SQL

SQL_MACROS = {
    "f_date(d DATE) RETURNS STRING": "date_format(d, 'yyyy-MM-dd')",
    "f_date_path(d DATE) RETURNS STRING": "date_format(d, 'yyyy/MM/dd')",
    "eomonth(d DATE, k INT) RETURNS DATE": "last_day(add_months(d, k))",
    "text_to_datetime(s STRING) RETURNS TIMESTAMP_NTZ": TEXT_MONTH_SQL.format(c="s"),
}


def register_macros(spark: SparkSession) -> None:
    """Create the macros as temporary functions of the session."""
    for signature, body in SQL_MACROS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
