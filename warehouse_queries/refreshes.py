"""Refresh modes as pure DataFrame algebra."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.refresh import Mode, RefreshSpec, delete_where, refresh, upsert
from warehouse_queries.registry import query, table

ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_orderdate"


def orders(spark, d):
    return table(spark, d, "orders")


def cheaper(df):
    return df.withColumn("o_totalprice", F.col("o_totalprice") - 1)


@query(
    "refresh_full",
    f"SELECT {ORDER_COLUMNS}, o_totalprice - 1 AS o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'F'",
)
def refresh_full(spark, d):
    t = orders(spark, d)
    return refresh(t, cheaper(t.where("o_orderstatus = 'F'")), RefreshSpec(refresh_type=Mode.FULL))


@query(
    "refresh_masterdata",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal > 0",
)
def refresh_masterdata(spark, d):
    t = table(spark, d, "supplier")
    return refresh(t, t.where("s_acctbal > 0"), RefreshSpec(ingest_type="MASTERDATA"))


@query(
    "refresh_partition",
    f"""
    SELECT {ORDER_COLUMNS}, o_totalprice, o_orderpriority FROM orders
    WHERE NOT (o_orderdate = TIMESTAMP '1997-03-15')
    UNION ALL
    SELECT {ORDER_COLUMNS}, o_totalprice - 1, o_orderpriority FROM orders WHERE o_orderdate = TIMESTAMP '1997-03-15'
    """,
)
def refresh_partition(spark, d):
    t = orders(spark, d)
    batch = cheaper(t.where("o_orderdate = TIMESTAMP_NTZ '1997-03-15'"))
    spec = RefreshSpec(refresh_type="PARTITION", partition_column="o_orderdate", partition_value="1997-03-15")
    return refresh(t, batch, spec)


MONTH_SQL = f"""
    SELECT {ORDER_COLUMNS}, o_totalprice, o_orderpriority FROM orders
    WHERE NOT (o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01')
    UNION ALL
    SELECT {ORDER_COLUMNS}, o_totalprice - 1, o_orderpriority FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01' AND o_orderstatus = 'F'
"""


def march(t):
    return cheaper(t.where("o_orderdate >= '1997-03-01' AND o_orderdate < '1997-04-01' AND o_orderstatus = 'F'"))


@query("refresh_mtd", MONTH_SQL)
def refresh_mtd(spark, d):
    t = orders(spark, d)
    spec = RefreshSpec(refresh_type="PARTITION_MTD", partition_column="o_orderdate", partition_value="1997-03-20")
    return refresh(t, march(t), spec)


@query("refresh_ingest_mtd", MONTH_SQL)
def refresh_ingest_mtd(spark, d):
    t = orders(spark, d)
    spec = RefreshSpec(ingest_type="MTD", partition_column="o_orderdate", partition_value="1997-03")
    return refresh(t, march(t), spec)


EVENT_COLUMNS = "event_id, ts, user_id, event_type, props"
BOUNDS_SQL = f"""
    WITH b AS (SELECT * FROM events WHERE event_type = 'click'
               AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13')
    SELECT {EVENT_COLUMNS}, value FROM events
    WHERE NOT (ts >= (SELECT CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) FROM b)
           AND ts < (SELECT CAST(CAST(max(ts) AS DATE) + 1 AS TIMESTAMP) FROM b))
    UNION ALL SELECT {EVENT_COLUMNS}, value + 1000 FROM b
"""


def three_days(t):
    clicks = t.where("event_type = 'click' AND ts >= '2024-01-10' AND ts < '2024-01-13'")
    return clicks.withColumn("value", F.col("value") + 1000)


@query("refresh_n_days_batch_bounds", BOUNDS_SQL)
def refresh_n_days_batch_bounds(spark, d):
    t = table(spark, d, "events")
    return refresh(t, three_days(t), RefreshSpec(refresh_type="PARTITION_N_DAYS", partition_column="ts"))


@query("refresh_back_fill_n_days", BOUNDS_SQL)
def refresh_back_fill_n_days(spark, d):
    t = table(spark, d, "events")
    return refresh(t, three_days(t), RefreshSpec(ingest_type="BACK_FILL_N_DAYS", partition_column="ts"))


@query(
    "refresh_n_days_window",
    f"""
    SELECT {EVENT_COLUMNS}, value FROM events
    WHERE NOT (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-16')
    UNION ALL SELECT {EVENT_COLUMNS}, value + 1000 FROM events WHERE event_type = 'click'
           AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13'
    """,
)
def refresh_n_days_window(spark, d):
    t = table(spark, d, "events")
    spec = RefreshSpec(
        refresh_type="PARTITION_N_DAYS", partition_column="ts", partition_value="2024-01-15", n_days=5
    )
    return refresh(t, three_days(t), spec)


CDC_SQL = """
    WITH b AS (SELECT doc_id, n_chars + 1 AS n_chars, source AS FILE_NAME FROM documents WHERE source LIKE 'src1%')
    SELECT doc_id, n_chars, source AS FILE_NAME FROM documents
    WHERE source NOT IN (SELECT DISTINCT FILE_NAME FROM b)
    UNION ALL SELECT doc_id, n_chars, FILE_NAME FROM b
"""


@query("refresh_cdc_file", CDC_SQL)
def refresh_cdc_file(spark, d):
    t = table(spark, d, "documents").select("doc_id", "n_chars", F.col("source").alias("FILE_NAME"))
    batch = t.where("FILE_NAME LIKE 'src1%'").withColumn("n_chars", F.col("n_chars") + 1)
    return refresh(t, batch, RefreshSpec(ingest_type="CDC"))


@query(
    "refresh_cdc_many_files",
    """
    WITH d AS (SELECT doc_id, source || '/' || doc_id AS FILENAME, lang || '/' || doc_id AS FILE_NAME FROM documents),
    b AS (SELECT doc_id, FILENAME, FILENAME AS FILE_NAME FROM d WHERE FILENAME LIKE 'src1%')
    SELECT doc_id, FILENAME, FILE_NAME FROM d
    WHERE FILENAME NOT IN (SELECT FILE_NAME FROM b) AND FILE_NAME NOT IN (SELECT FILE_NAME FROM b)
    UNION ALL SELECT doc_id, FILENAME, FILE_NAME FROM b
    """,
)
def refresh_cdc_many_files(spark, d):
    """Both file columns present, and one file per document: the join form beyond a short IN list."""
    t = table(spark, d, "documents").select(
        "doc_id",
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("FILENAME"),
        F.concat("lang", F.lit("/"), F.col("doc_id").cast("string")).alias("FILE_NAME"),
    )
    batch = t.where("FILENAME LIKE 'src1%'").withColumn("FILE_NAME", F.col("FILENAME"))
    return refresh(t, batch, RefreshSpec(ingest_type="CDC"))


@query(
    "refresh_append_only",
    "SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_acctbal < 0",
)
def refresh_append_only(spark, d):
    t = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    out = refresh(t, t.where("c_acctbal < 0"), RefreshSpec(ingest_type="INCREMENTAL"))
    return out.select("c_custkey", "c_name")


@query(
    "refresh_null_partition_survives",
    """
    WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS o_orderdate FROM orders)
    SELECT * FROM t WHERE NOT coalesce(o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01', FALSE)
    UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate = TIMESTAMP '1997-03-02'
    """,
)
def refresh_null_partition_survives(spark, d):
    source = orders(spark, d)
    t = source.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("o_orderdate"))
    batch = source.where("o_orderdate = '1997-03-02'").select("o_orderkey", "o_orderdate")
    spec = RefreshSpec(refresh_type="PARTITION_MTD", partition_column="o_orderdate", partition_value="1997-03-01")
    return refresh(t, batch, spec)


@query(
    "delete_by_predicate",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT coalesce(o_totalprice > 400000, FALSE)",
)
def delete_by_predicate(spark, d):
    t = orders(spark, d).select("o_orderkey", "o_totalprice")
    return delete_where(t, F.col("o_totalprice") > 400000)


@query(
    "upsert_by_key",
    """
    WITH r AS (
      SELECT c_custkey, 0.0 AS c_acctbal, 1 AS version FROM customer WHERE c_acctbal < 0
      UNION ALL SELECT c_custkey, 5.0, 2 FROM customer WHERE c_acctbal < -500
      UNION ALL SELECT c_custkey + 1000000000, c_acctbal, 1 FROM customer WHERE c_mktsegment = 'BUILDING'
    ), last AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY version DESC) AS n FROM r)
    SELECT c_custkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal FROM customer
    WHERE c_custkey NOT IN (SELECT c_custkey FROM r)
    UNION ALL SELECT c_custkey, CAST(c_acctbal AS DOUBLE) FROM last WHERE n = 1
    """,
)
def upsert_by_key(spark, d):
    t = table(spark, d, "customer")
    first = t.where("c_acctbal < 0").selectExpr("c_custkey", "0.0D AS c_acctbal", "1 AS version")
    second = t.where("c_acctbal < -500").selectExpr("c_custkey", "5.0D AS c_acctbal", "2 AS version")
    new = t.where("c_mktsegment = 'BUILDING'").selectExpr("c_custkey + 1000000000 AS c_custkey", "c_acctbal", "1 AS version")
    records = first.unionByName(second).unionByName(new)
    return upsert(t.select("c_custkey", "c_acctbal"), records, ["c_custkey"], ["version"])
