"""Column functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from millrace.context import RunContext
from millrace.functions import dates, naming, text
from millrace.functions.audit import add_audit
from millrace.plans.sql import run_sql
from warehouse_queries.registry import query, table

CTX = RunContext("2024-01-31", "job-1", datetime(2024, 2, 1, 8, 30))


def _naming_sql(column: str) -> str:
    sql = f"replace(replace({column}, '>', 'gt_'), '<', 'lt_')"
    for pattern, _, to in (
        (r"[^\p{L}\p{N}_]+", "", "_"),
        (r"^(\p{Nd})", "", r"C_\1"),
        ("^_", "", ""),
        ("_$", "", ""),
        ("_+", "", "_"),
    ):
        sql = f"regexp_replace({sql}, '{pattern}', '{to}', 'g')"
    # DuckDB keeps one capital letter for the German sharp s, which is SS in Unicode.
    return f"upper(replace(translate({sql}, '{naming.ACCENT_FROM}', '{naming.ACCENT_TO}'), 'ß', 'ss'))"


@query("normalize_names_values", f"SELECT page_id, {_naming_sql('url')} AS name FROM pages")
def normalize_names_values(spark, d):
    return table(spark, d, "pages").select("page_id", naming.normalize_values("url").alias("name"))


@query(
    "normalize_text_values",
    f"SELECT doc_id, {_naming_sql('''doc_id || ' điểm >= ' || text''')} AS name FROM documents",
)
def normalize_text_values(spark, d):
    documents = table(spark, d, "documents")
    value = F.concat(F.col("doc_id").cast("string"), F.lit(" điểm >= "), F.col("text"))
    return documents.select("doc_id", naming.normalize_values(value).alias("name"))


@query("fold_accents", f"SELECT doc_id, translate('Số Điểm ' || text, '{naming.ACCENT_FROM}', '{naming.ACCENT_TO}') AS plain FROM documents")
def fold_accents(spark, d):
    value = F.concat(F.lit("Số Điểm "), F.col("text"))
    return table(spark, d, "documents").select("doc_id", naming.fold_accents(value).alias("plain"))


@query(
    "excel_serial_dates",
    """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
           CAST(DATE '1899-12-30' + CAST(o_custkey AS INTEGER) AS VARCHAR) AS ship_date, o_custkey
    FROM orders
    """,
)
def excel_serial_dates(spark, d):
    df = table(spark, d, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_custkey").cast("int").alias("ship_date"), "o_custkey"
    )
    out = dates.standardize_dates(df)
    return out.withColumns({c: F.col(c).cast("string") for c in ("o_orderdate", "ship_date")})


@query(
    "parse_date_pattern",
    """
    SELECT o_orderkey, CASE o_orderstatus
      WHEN 'F' THEN CAST(DATE '1899-12-30' + CAST(o_custkey AS INTEGER) AS TIMESTAMP)
      WHEN 'O' THEN CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) END AS day
    FROM orders
    """,
)
def parse_date_pattern(spark, d):
    """Serial numbers with decimals, month labels and blanks in one text column."""
    label = F.concat(F.lit("M"), F.month("o_orderdate").cast("string"), F.lit("."), F.year("o_orderdate").cast("string"))
    mixed = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.col("o_custkey").cast("string"), F.lit(".7")))
        .when(F.col("o_orderstatus") == "O", label)
        .otherwise("")
    )
    df = table(spark, d, "orders").select("o_orderkey", mixed.alias("day"))
    return dates.parse_dates(df, ["day"], "M%m.%Y")


@query(
    "parse_compact_dates",
    "SELECT o_orderkey, o_orderdate AS day, CAST(NULL AS TIMESTAMP) AS wrong FROM orders",
)
def parse_compact_dates(spark, d):
    """Digits that are no serial number follow the pattern; lenient misfits are NULL."""
    text = F.date_format("o_orderdate", "yyyyMMdd")
    return table(spark, d, "orders").select(
        "o_orderkey",
        dates.parse_date(text, "%Y%m%d").alias("day"),
        dates.parse_date(F.concat(F.lit("x"), text), "%Y%m%d", strict=False).alias("wrong"),
    )


MONTHS = "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month FROM orders"


@query("parse_month_label", MONTHS)
def parse_month_label(spark, d):
    label = F.concat(F.lit("M"), F.month("o_orderdate").cast("string"), F.lit("."), F.year("o_orderdate").cast("string"))
    return table(spark, d, "orders").select("o_orderkey", dates.parse_month_label(label).alias("month"))


TEXT_MONTHS = """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) END AS month
    FROM orders
"""


def month_texts(spark, d):
    separator = F.when(F.col("o_orderstatus") == "F", "/").otherwise("-")
    label = F.concat(F.lit("M"), F.month("o_orderdate").cast("string"), separator, F.year("o_orderdate").cast("string"))
    return table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", label).alias("label"))


@query("text_month_to_date", TEXT_MONTHS)
def text_month_to_date(spark, d):
    return month_texts(spark, d).select("o_orderkey", dates.text_month("label").alias("month"))


@query("sql_macro", TEXT_MONTHS)
def sql_macro(spark, d):
    text = "SELECT o_orderkey, text_to_datetime(label) AS month FROM labels_in"
    return run_sql(spark, text, refs={"labels_in": month_texts(spark, d)})


@query(
    "blank_to_null",
    """
    SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment,
           CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer
    """,
)
def blank_to_null(spark, d):
    df = table(spark, d, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_acctbal") < 0, float("nan")).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
    )
    return text.blank_to_null(df)


@query(
    "audit_columns",
    "SELECT s_suppkey, 'job-1' AS BATCH_JOB_ID, '2024-02-01 08:30:00' AS EDW_UPDATE_DTTM, "
    "'supplier.parquet' AS FILE_NAME FROM supplier",
)
def audit_columns(spark, d):
    from millrace.functions.audit import row_file_name

    df = table(spark, d, "supplier").select("s_suppkey", row_file_name().alias("name"))
    return add_audit(df, CTX, F.col("name")).drop("name")


@query(
    "human_size",
    """
    SELECT doc_id, CASE
      WHEN b < 1024 THEN printf('%.2f', b) || ' B'
      WHEN b < 1048576 THEN printf('%.2f', b / 1024) || ' KiB'
      WHEN b < 1073741824 THEN printf('%.2f', b / 1048576) || ' MiB'
      ELSE printf('%.2f', b / 1073741824) || ' GiB' END AS size
    FROM (SELECT doc_id, CAST(n_chars AS DOUBLE) * n_chars AS b FROM documents)
    """,
)
def human_size(spark, d):
    size = F.col("n_chars").cast("double") * F.col("n_chars")
    return table(spark, d, "documents").select("doc_id", text.human_size(size).alias("size"))


@query(
    "tz_shift",
    """
    SELECT event_id, ts + INTERVAL 7 HOUR AS local, ts - INTERVAL 7 HOUR AS utc,
           coalesce(strftime(CASE WHEN event_type <> 'error' THEN ts + INTERVAL 7 HOUR END, '%Y-%m-%d %H:%M:%S') || ' +07', '') AS label
    FROM events
    """,
)
def tz_shift(spark, d):
    return table(spark, d, "events").select(
        "event_id",
        dates.shift_zone("ts", "UTC", "Asia/Bangkok").alias("local"),
        dates.shift_zone("ts").alias("utc"),
        dates.format_in_zone(F.when(F.col("event_type") != "error", F.col("ts"))).alias("label"),
    )


@query(
    "epoch_ts",
    "SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts FROM events",
)
def epoch_ts(spark, d):
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    return table(spark, d, "events").select("event_id", dates.epoch_seconds(seconds).alias("ts"))


@query(
    "to_json",
    "SELECT event_id, CAST(to_json({'event_id': event_id, 'event_type': event_type}) AS VARCHAR) AS body, "
    "CAST(to_json([event_type, 'x']) AS VARCHAR) AS tags FROM events",
)
def to_json(spark, d):
    return table(spark, d, "events").select(
        "event_id",
        text.to_json_text(F.struct("event_id", "event_type")).alias("body"),
        text.to_json_text(F.array("event_type", F.lit("x"))).alias("tags"),
    )


@query(
    "base64",
    "SELECT doc_id, base64(encode(text)) AS encoded, text AS decoded FROM documents",
)
def base64(spark, d):
    encoded = text.base64_encode("text")
    return table(spark, d, "documents").select(
        "doc_id", encoded.alias("encoded"), text.base64_decode(encoded).alias("decoded")
    )


@query(
    "path_parts",
    r"""
    SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base, regexp_extract(url, '^(.*)/[^/]*$', 1) AS parent,
           lower(regexp_extract(regexp_extract(url, '([^/]*)$', 1), '[^.]\.([^.]+)$', 1)) AS suffix,
           regexp_replace(regexp_extract(url, '([^/]*)$', 1), '([^.])\.[^.]+$', '\1') AS stem
    FROM pages
    """,
)
def path_parts(spark, d):
    return table(spark, d, "pages").select(
        "page_id",
        text.base_name("url").alias("base"),
        text.parent_path("url").alias("parent"),
        text.suffix("url").alias("suffix"),
        text.stem("url").alias("stem"),
    )


@query(
    "file_key",
    "SELECT event_id, event_type || user_id || strftime(ts, '%Y%m%d%H%M%S') AS key FROM events",
)
def file_key(spark, d):
    key = text.file_key("event_type", F.col("user_id").cast("string"), "ts")
    return table(spark, d, "events").select("event_id", key.alias("key"))


@query(
    "duration_seconds",
    "SELECT event_id, date_diff('second', TIMESTAMP '2024-01-01 00:00:00.5', ts) AS seconds FROM events",
)
def duration_seconds(spark, d):
    start = F.lit("2024-01-01 00:00:00.5").cast("timestamp_ntz")
    return table(spark, d, "events").select("event_id", dates.duration_seconds(start, "ts").alias("seconds"))


@query(
    "date_formats",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y/%m/%d') AS path,
           strftime(o_orderdate, '%Y-%m-%d') AS passed, o_orderdate AS parsed,
           CAST(last_day(CAST(o_orderdate AS DATE)) AS VARCHAR) AS month_end
    FROM orders
    """,
)
def date_formats(spark, d):
    day = dates.format_date("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey",
        day.alias("day"),
        dates.format_date_path(day).alias("path"),
        dates.format_date(day, is_text=True).alias("passed"),
        dates.to_day(day).alias("parsed"),
        dates.month_end("o_orderdate").cast("string").alias("month_end"),
    )


@query(
    "interval_arithmetic",
    "SELECT o_orderkey, o_orderdate + INTERVAL 10 DAY AS later, o_orderdate - INTERVAL 1 MONTH AS before FROM orders",
)
def interval_arithmetic(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        dates.plus_days("o_orderdate", 10).alias("later"),
        dates.plus_months("o_orderdate", -1).alias("before"),
    )


@query(
    "prefix_and_default",
    """
    SELECT o_orderkey, CASE WHEN starts_with(o_orderpriority, '1-') THEN substr(o_orderpriority, 3) ELSE o_orderpriority END AS priority,
           starts_with(o_orderpriority, '1-') AS is_first,
           coalesce(CASE WHEN o_orderstatus <> 'P' THEN round(o_totalprice, 0) END, 0) AS price
    FROM orders
    """,
)
def prefix_and_default(spark, d):
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        text.remove_prefix("o_orderpriority", "1-").alias("priority"),
        F.startswith("o_orderpriority", F.lit("1-")).alias("is_first"),
        text.round_or_zero(price, 0).alias("price"),
    )


@query("content_hash", "SELECT doc_id, sha256(text) AS hash FROM documents")
def content_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", text.content_sha("text", 256).alias("hash"))


@query(
    "name_filter",
    """
    SELECT page_id, contains(url, '.html') AS by_text, regexp_matches(url, '^https://.+[0-9]$') AS by_regex
    FROM pages WHERE contains(url, 'example')
    """,
)
def name_filter(spark, d):
    pages = table(spark, d, "pages").where(text.name_matches("url", "example"))
    return pages.select(
        "page_id",
        text.name_matches("url", ".html").alias("by_text"),
        text.name_matches("url", "^https://.+[0-9]$").alias("by_regex"),
    )
