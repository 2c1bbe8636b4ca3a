"""Aggregates, joins, windows, sorts, set operations, header promotion, SQL with inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import relational as R
from millrace.plans.sql import run_sql
from millrace.sources.workbook import below_header, header_row
from warehouse_queries.registry import query, table

MONTHLY_SALES = """
    SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS month, l_returnflag,
           CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS revenue,
           CAST(sum(CAST(l_quantity AS DECIMAL(18, 4))) AS DOUBLE) AS quantity
    FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31 23:59:59'
    GROUP BY 1, 2
"""


@query("monthly_sales", MONTHLY_SALES)
def monthly_sales(spark, d):
    sums = {"revenue": F.col("l_extendedprice") * (1 - F.col("l_discount")), "quantity": F.col("l_quantity")}
    return R.monthly_totals(
        table(spark, d, "lineitem"), "l_shipdate", ["l_returnflag"], sums, "1996-01-01", "1998-12-31 23:59:59"
    )


@query(
    "group_sum_five_keys",
    """
    SELECT l_returnflag, l_linestatus, l_suppkey, l_linenumber, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS month,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 4))) AS DOUBLE) AS gross,
           CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS net
    FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31' GROUP BY ALL
    """,
)
def group_sum_five_keys(spark, d):
    price = F.col("l_extendedprice")
    return R.monthly_totals(
        table(spark, d, "lineitem"),
        "l_shipdate",
        ["l_returnflag", "l_linestatus", "l_suppkey", "l_linenumber"],
        {"gross": price, "net": price * (1 - F.col("l_discount"))},
        "1997-01-01",
        "1997-12-31",
    )


@query("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, d):
    return table(spark, d, "lineitem").agg(F.count("*").alias("n_rows"))


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(spark, d):
    return table(spark, d, "orders").select("o_orderpriority").distinct()


@query(
    "catalog_join",
    """
    SELECT n_nationkey, n_name, r_name, s.n_suppliers FROM nation JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN (SELECT s_nationkey, count(*) AS n_suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) s
      ON s.s_nationkey = n_nationkey
    """,
)
def catalog_join(spark, d):
    nation = table(spark, d, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    suppliers = table(spark, d, "supplier").where("s_acctbal > 5000")
    counts = suppliers.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n_suppliers"))
    out = R.lookup(nation, table(spark, d, "region"), counts, "r_regionkey", "n_nationkey")
    return out.select("n_nationkey", "n_name", "r_name", "n_suppliers")


@query(
    "join_to_aggregate",
    """
    SELECT c_custkey, c_nationkey, p.priorities FROM customer LEFT JOIN (
      SELECT o_custkey, string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities
      FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) GROUP BY o_custkey) p ON p.o_custkey = c_custkey
    """,
)
def join_to_aggregate(spark, d):
    details = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority").distinct()
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return R.join_aggregate(customers, details, ["c_custkey"], "o_orderpriority", "priorities")


@query(
    "text_lists",
    """
    SELECT o_orderpriority, count(*) AS n_texts,
           string_agg(o_clerk, ';' ORDER BY o_clerk) AS clerks FROM (
      SELECT o_orderpriority, CAST(o_custkey AS VARCHAR) AS o_clerk FROM orders) GROUP BY o_orderpriority
    """,
)
def text_lists(spark, d):
    """All customers of all orders under few priorities: groups of many rows, with repeated texts."""
    texts = table(spark, d, "orders").select("o_orderpriority", F.col("o_custkey").cast("string").alias("o_clerk"))
    listed = R.text_lists(texts, ["o_orderpriority"], "o_clerk", "clerks", ";")
    counts = texts.groupBy("o_orderpriority").agg(F.count("*").alias("n_texts"))
    return counts.join(listed, "o_orderpriority")


@query(
    "run_bounds_window",
    """
    SELECT event_id, user_id, ts, min(ts) OVER (PARTITION BY user_id) AS group_start,
           max(ts) OVER (PARTITION BY user_id) AS group_end FROM events
    """,
)
def run_bounds_window(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "ts")
    return R.group_bounds(events, ["user_id"], "ts", "ts")


@query(
    "top_n_with_total",
    """
    WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
    SELECT 'ALL' AS customer, CAST(sum(n) AS BIGINT) AS n, 1 AS priority FROM c UNION ALL
    (SELECT CAST(o_custkey AS VARCHAR), n, 0 FROM c ORDER BY n DESC, CAST(o_custkey AS VARCHAR) LIMIT 10)
    """,
)
def top_n_with_total(spark, d):
    counts = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("customer")).agg(F.count("*").alias("n"))
    return R.top_with_total(counts, "customer", "n", 10)


@query(
    "first_n_sorted",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def first_n_sorted(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return R.first_n(orders, 100, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query(
    "multi_key_sort",
    "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_shipdate FROM lineitem ORDER BY ALL",
)
def multi_key_sort(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    return lines.orderBy("l_returnflag", "l_linestatus", "l_shipdate", "l_orderkey", "l_linenumber")


@query(
    "union_by_name",
    """
    SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS supplier FROM customer
    UNION ALL SELECT s_name, 'N' || s_nationkey, NULL, s_suppkey FROM supplier
    """,
)
def union_by_name(spark, d):
    """A number on one side and text on the other meet as text."""
    customers = table(spark, d, "customer").selectExpr("c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment")
    suppliers = table(spark, d, "supplier").selectExpr(
        "s_suppkey AS supplier", "s_name AS name", "concat('N', s_nationkey) AS nation"
    )
    return R.union_by_name([customers, suppliers])


@query(
    "concatenate",
    "SELECT c_nationkey AS nation, 'customer' AS kind FROM customer UNION ALL SELECT s_nationkey, 'supplier' FROM supplier",
)
def concatenate(spark, d):
    customers = table(spark, d, "customer").selectExpr("c_nationkey AS nation", "'customer' AS kind")
    return customers.unionByName(table(spark, d, "supplier").selectExpr("'supplier' AS kind", "s_nationkey AS nation"))


@query(
    "set_difference",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)",
)
def set_difference(spark, d):
    buyers = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return R.difference(table(spark, d, "customer").select("c_custkey"), buyers, ["c_custkey"])


@query(
    "set_intersection",
    "SELECT o_custkey AS custkey FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal < 0",
)
def set_intersection(spark, d):
    poor = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("custkey"))
    return R.intersection(table(spark, d, "orders").select(F.col("o_custkey").alias("custkey")), poor, ["custkey"])


@query(
    "drop_all_null_rows",
    """
    SELECT * FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS a,
                          CASE WHEN o_totalprice > 300000 THEN o_totalprice END AS b FROM orders)
    WHERE coalesce(a, b) IS NOT NULL
    """,
)
def drop_all_null_rows(spark, d):
    orders = table(spark, d, "orders")
    return R.drop_all_null(
        orders.select(
            F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("a"),
            F.when(F.col("o_totalprice") > 300000, F.col("o_totalprice")).alias("b"),
        )
    )


@query(
    "rename_drop",
    "SELECT c_custkey AS customer, c_name AS name, c_mktsegment FROM customer",
)
def rename_drop(spark, d):
    return R.rename_drop(
        table(spark, d, "customer"), {"c_custkey": "customer", "c_name": "name"}, ["c_nationkey", "c_acctbal"]
    )


def sheets(spark, d):
    """Every conversation as a sheet: a turn is a row, its words are cells."""
    return table(spark, d, "conversations").select(
        F.col("conv_id").alias("sheet"),
        (F.col("turn") + 1).cast("int").alias("row_index"),
        F.transform(F.split("text", " "), lambda w: F.nullif(w, F.lit(""))).alias("cells"),
    )


HEADERS = """
    c AS (SELECT conv_id AS sheet, CAST(turn + 1 AS INTEGER) AS row_index,
                 len(list_distinct(list_filter(string_split(text, ' '), lambda w: w <> ''))) AS n FROM conversations),
    h AS (SELECT sheet, arg_max(row_index, n * 1000000 - row_index) AS header_row FROM c GROUP BY sheet)
"""


@query("promote_header", f"WITH {HEADERS} SELECT sheet, header_row FROM h")
def promote_header(spark, d):
    return header_row(sheets(spark, d), ["sheet"]).select("sheet", "header_row")


@query(
    "rows_below_header",
    f"WITH {HEADERS} SELECT c.sheet, c.row_index, h.header_row FROM c JOIN h USING (sheet) WHERE c.row_index > h.header_row",
)
def rows_below_header(spark, d):
    return below_header(sheets(spark, d), ["sheet"]).select("sheet", "row_index", "header_row")


@query(
    "sql_with_refs",
    """
    SELECT o_orderpriority, count(*) AS n, strftime(DATE '1997-03-01', '%Y/%m/%d') AS path FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01' AND o_totalprice > 100000
    GROUP BY o_orderpriority
    """,
)
def sql_with_refs(spark, d):
    text = """
        WITH slice AS (
            SELECT * FROM sales_orders
            WHERE o_orderdate >= CAST('[[ run_date ]]' AS TIMESTAMP_NTZ)
              AND o_orderdate < CAST(date_add(eomonth(DATE'[[ run_date ]]', 0), 1) AS TIMESTAMP_NTZ)
              AND o_totalprice > :least
        )
        SELECT o_orderpriority, count(*) AS n, f_date_path(DATE'[[ run_date ]]') AS path FROM slice GROUP BY o_orderpriority
    """
    return run_sql(
        spark, text, args={"run_date": "1997-03"}, refs={"sales_orders": table(spark, d, "orders")}, params={"least": 100000}
    )
