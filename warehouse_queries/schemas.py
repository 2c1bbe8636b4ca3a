"""Schema reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import schema as S
from millrace.operators.relational import cast_columns
from warehouse_queries.registry import query, table

PART = "p_partkey, p_name, p_brand, p_type, p_size, p_retailprice"


@query(
    "schema_missing_columns",
    "SELECT p_partkey, p_name, p_brand, CAST(NULL AS VARCHAR) AS p_type, CAST(NULL AS INTEGER) AS p_size, "
    "p_retailprice FROM part",
)
def schema_missing_columns(spark, d):
    part = table(spark, d, "part")
    return S.order_columns(S.add_missing_columns(part.drop("p_type", "p_size"), part.schema), part.schema)


@query("schema_ignore_new", f"SELECT {PART} FROM part")
def schema_ignore_new(spark, d):
    part = table(spark, d, "part")
    return S.ignore_new_columns(part.withColumn("p_extra", F.length("p_name")), part.schema)


@query(
    "schema_evolve",
    f"SELECT {PART}, CAST(NULL AS DOUBLE) AS p_margin FROM part UNION ALL "
    f"SELECT {PART}, CAST(CAST(p_retailprice / 8 AS DECIMAL(30, 8)) AS DOUBLE) FROM part WHERE p_size < 10",
)
def schema_evolve(spark, d):
    part = table(spark, d, "part")
    batch = part.where("p_size < 10").withColumn("p_margin", F.col("p_retailprice") / 8)
    old, new = S.evolve(part, batch)
    return old.unionByName(new).withColumn("p_margin", F.col("p_margin").cast("double"))


LINE = "l_orderkey, l_linenumber"


@query(
    "schema_sync_types",
    f"SELECT {LINE}, CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS l_quantity, l_shipdate FROM lineitem",
)
def schema_sync_types(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag")
    text = lines.select(
        *[F.col(c).cast("string").alias(c) for c in ("l_orderkey", "l_linenumber", "l_shipdate")],
        F.when(F.col("l_returnflag") == "N", "n/a").otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
    )
    sink = lines.drop("l_returnflag").schema
    return S.order_columns(S.sync_types(text, sink, strict=False), sink)


@query(
    "schema_cast_losses",
    """
    SELECT 'l_orderkey' AS column_name, CAST(0 AS BIGINT) AS n_lost UNION ALL
    SELECT 'l_quantity', count(*) FROM lineitem WHERE l_returnflag = 'N'
    """,
)
def schema_cast_losses(spark, d):
    lines = table(spark, d, "lineitem")
    text = lines.select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.when(F.col("l_returnflag") == "N", "n/a").otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
    )
    return S.cast_losses(text, lines.select("l_orderkey", "l_quantity").schema)


@query(
    "schema_reconcile",
    """
    SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_comment, o_totalprice, o_orderdate, o_orderstatus = 'F' AS is_final
    FROM orders
    """,
)
def schema_reconcile(spark, d):
    """The whole order of steps: missing, new, NULL check, user transform, type sync."""
    orders = table(spark, d, "orders")
    sink = T.StructType.fromDDL(
        "o_orderkey bigint not null, o_comment string, o_totalprice double, o_orderdate timestamp_ntz"
    )
    batch = orders.withColumn("o_totalprice", F.col("o_totalprice").cast("string")).withColumn(
        "o_orderdate", F.col("o_orderdate").cast("string")
    )
    status = orders.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("is_final"))
    return S.reconcile(batch, sink, lambda df: df.join(status, "o_orderkey"))


@query(
    "null_violation_report",
    """
    SELECT 'o_orderkey' AS column_name, CAST(0 AS BIGINT) AS n_nulls UNION ALL
    SELECT 'o_orderdate', count(*) FROM orders WHERE o_orderstatus = 'P' UNION ALL
    SELECT 'o_totalprice', count(*) FROM orders WHERE o_totalprice > 400000
    """,
)
def null_violation_report(spark, d):
    batch = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("o_orderdate"),
        F.when(F.col("o_totalprice") <= 400000, F.col("o_totalprice")).alias("o_totalprice"),
    )
    return S.null_violations(batch, ["o_orderkey", "o_orderdate", "o_totalprice"])


@query(
    "string_width_profile",
    """
    SELECT 'text' AS column_name, max(length(text)) AS max_length, max(length(text)) > 1000 AS over_limit FROM documents
    UNION ALL SELECT 'lang', max(length(lang)), max(length(lang)) > 1000 FROM documents
    UNION ALL SELECT 'source', max(length(source)), max(length(source)) > 1000 FROM documents
    """,
)
def string_width_profile(spark, d):
    return S.width_profile(table(spark, d, "documents"))


@query(
    "cast_columns",
    "SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM lineitem",
)
def cast_columns_query(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate")
    return cast_columns(lines, {"l_quantity": "bigint", "l_shipdate": "string"})


@query(
    "transform_chain",
    "SELECT l_orderkey AS order_id, l_extendedprice * (1 - l_discount) AS net, 4 AS n_columns FROM lineitem "
    "WHERE l_quantity > 10",
)
def transform_chain(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount")

    def large(df):
        return df.where("l_quantity > 10")

    def net(df):
        return df.withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))

    def with_metadata(df, metadata, spark):
        return df.withColumn("n_columns", F.lit(len(metadata)))

    with_metadata.is_request_metadata = True

    def shape(df):
        return df.withColumnsRenamed({"l_orderkey": "order_id"}).drop("l_quantity", "l_extendedprice", "l_discount")

    return S.apply_transforms(lines, [large, net, with_metadata, shape], metadata=lines.columns)


@query(
    "sink_metadata",
    """
    SELECT 1 AS COLUMN_ID, 'o_orderkey' AS COL_NAME, 'bigint' AS DATA_TYPE, count(o_orderkey) AS n_filled FROM orders
    UNION ALL SELECT 2, 'o_custkey', 'bigint', count(o_custkey) FROM orders
    UNION ALL SELECT 3, 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
    UNION ALL SELECT 4, 'o_totalprice', 'double', count(o_totalprice) FROM orders
    UNION ALL SELECT 5, 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
    UNION ALL SELECT 6, 'o_orderpriority', 'string', count(o_orderpriority) FROM orders
    """,
)
def sink_metadata(spark, d):
    """Column metadata of a table beside the filled values of each column."""
    orders = table(spark, d, "orders")
    filled = orders.agg(*[F.count(c).alias(c) for c in orders.columns])
    counts = filled.unpivot([], orders.columns, "COL_NAME", "n_filled")
    return S.column_metadata(orders).join(counts, "COL_NAME").drop("IS_NULLABLE")
