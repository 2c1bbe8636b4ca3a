"""Change detection, latest versions, slowly changing dimensions, lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import changes as C
from millrace.operators import lineage
from millrace.operators.reconcile import content_mismatch, distinct_months, month_mismatch, reconcile_totals, row_differences
from warehouse_queries.registry import query, table

# Documents stand for listed files: one folder per language, the id in the name.
FILES_SQL = """
    files AS (SELECT doc_id, lang AS parent_path, 'doc_' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '.csv' AS filename,
                     TIMESTAMP '2024-01-01' + to_seconds(doc_id) AS last_modified_dt, n_chars AS st_size FROM documents),
    log AS (SELECT f.parent_path, f.filename, f.last_modified_dt - to_seconds(l.toxic) AS last_modified_dt
            FROM files f JOIN labels l USING (doc_id)),
    imported AS (SELECT DISTINCT f.filename FROM files f JOIN labels l USING (doc_id) WHERE l.quality = 1)
"""
NEW_SQL = f"""
    WITH {FILES_SQL}
    SELECT parent_path, filename, last_modified_dt, st_size, parent_path || '/' || filename AS full_path
    FROM files f WHERE NOT EXISTS (SELECT 1 FROM log g WHERE g.parent_path = f.parent_path
        AND g.filename = f.filename AND g.last_modified_dt = f.last_modified_dt)
"""


def files(spark, d):
    moment = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.col("doc_id")
    )
    name = F.concat(F.lit("doc_"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.lit(".csv"))
    return table(spark, d, "documents").select(
        "doc_id",
        F.col("lang").alias("parent_path"),
        name.alias("filename"),
        moment.alias("last_modified_dt"),
        F.col("n_chars").alias("st_size"),
    )


def listing(spark, d):
    return files(spark, d).drop("doc_id")


def log(spark, d):
    seen = files(spark, d).join(table(spark, d, "labels").select("doc_id", "toxic"), "doc_id")
    back = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("toxic"))
    return seen.select("parent_path", "filename", (F.col("last_modified_dt") - back).alias("last_modified_dt"))


def imported(spark, d):
    good = table(spark, d, "labels").where("quality = 1").select("doc_id")
    sink = files(spark, d).join(good, "doc_id", "left_semi").select(F.col("filename").alias("FILE_NAME"))
    return C.imported_names(sink)


@query("new_files", NEW_SQL + " AND filename NOT IN (SELECT filename FROM imported)")
def new_files(spark, d):
    return C.new_files(listing(spark, d), log(spark, d), imported(spark, d), pattern="doc_")


@query("new_files_modified", NEW_SQL)
def new_files_modified(spark, d):
    return C.new_files(listing(spark, d), log(spark, d), imported(spark, d), reload_modified=True)


@query(
    "new_files_capped",
    NEW_SQL + " AND filename NOT IN (SELECT filename FROM imported) ORDER BY full_path LIMIT 20",
)
def new_files_capped(spark, d):
    return C.cap_files(C.new_files(listing(spark, d), log(spark, d), imported(spark, d)), C.FILES_PER_RUN)


@query(
    "new_files_newest",
    NEW_SQL + " AND filename NOT IN (SELECT filename FROM imported) ORDER BY full_path DESC LIMIT 1",
)
def new_files_newest(spark, d):
    return C.cap_files(C.new_files(listing(spark, d), log(spark, d), imported(spark, d)), newest_only=True)


@query(
    "masterdata_pick",
    NEW_SQL + " AND filename > (SELECT max(filename) FROM files WHERE parent_path = 'fr') ORDER BY filename DESC LIMIT 1",
)
def masterdata_pick(spark, d):
    """The sink holds all French files; the newest unlogged name above them is due."""
    have = C.imported_names(listing(spark, d).where("parent_path = 'fr'").withColumnRenamed("filename", "FILE_NAME"))
    return C.new_files(listing(spark, d), log(spark, d), have, masterdata=True)


@query(
    "unlogged_files",
    f"WITH {FILES_SQL} SELECT f.* EXCLUDE (doc_id) FROM files f LEFT JOIN log g "
    "ON g.parent_path = f.parent_path AND g.filename = f.filename AND g.last_modified_dt = f.last_modified_dt "
    "WHERE g.filename IS NULL",
)
def unlogged_files(spark, d):
    return C.unlogged(listing(spark, d), log(spark, d))


@query(
    "latest_per_key",
    """
    SELECT event_id, ts, user_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1
    """,
)
def latest_per_key(spark, d):
    events = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    return C.latest_per_key(events, ["user_id"], ["ts", "event_id"])


@query(
    "retention_expired",
    """
    SELECT event_id, user_id, ts FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n > 2
    """,
)
def retention_expired(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "ts")
    return C.retention_expired(events, ["user_id"], ["ts", "event_id"], 2)


@query(
    "latest_file_by_pattern",
    f"""
    WITH {FILES_SQL}
    SELECT 'doc_*1.csv' AS pattern, max(filename) AS filename FROM files WHERE filename LIKE 'doc\\_%1.csv' ESCAPE '\\'
    UNION ALL SELECT 'doc_0000??5*', max(filename) FROM files WHERE regexp_matches(filename, '^doc_0000..5')
    """,
)
def latest_file_by_pattern(spark, d):
    return C.latest_by_pattern(listing(spark, d), ["doc_*1.csv", "doc_0000??5*", "nothing*"])


@query(
    "changed_content",
    """
    WITH log AS (
      SELECT source AS file_name, sha256(text) AS h, doc_id AS st_mtime FROM documents WHERE n_chars < 2000
    ), last AS (SELECT file_name, arg_max(h, st_mtime) AS h FROM log GROUP BY file_name),
    now AS (SELECT source AS file_name, doc_id, sha256(text) AS h FROM documents)
    SELECT n.file_name, n.doc_id, n.h IS DISTINCT FROM l.h AS is_changed FROM now n LEFT JOIN last l USING (file_name)
    """,
)
def changed_content(spark, d):
    docs = table(spark, d, "documents").select(
        F.col("source").alias("file_name"), "doc_id", F.sha2("text", 256).alias("hash_check_sum"), "n_chars"
    )
    seen = docs.where("n_chars < 2000").withColumnRenamed("doc_id", "st_mtime")
    return C.changed_content(docs.drop("n_chars"), seen).select("file_name", "doc_id", "is_changed")


@query(
    "copy_plan",
    """
    WITH f AS (SELECT source, source || '_' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '.csv' AS filename, sha256(text) AS h,
                      n_chars FROM documents),
    s AS (SELECT source, max(filename) AS filename, arg_max(h, filename) AS h FROM f GROUP BY source),
    t AS (SELECT source, arg_max(h, filename) AS h FROM f WHERE n_chars < 5000 GROUP BY source)
    SELECT s.source, s.filename AS source_file, s.source || '_20240131.csv' AS target_file,
           CASE WHEN s.h IS DISTINCT FROM t.h THEN 'copy' ELSE 'skip' END AS action
    FROM s LEFT JOIN t USING (source)
    """,
)
def copy_plan(spark, d):
    name = F.concat("source", F.lit("_"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.lit(".csv"))
    both = table(spark, d, "documents").select(
        "source", name.alias("filename"), F.sha2("text", 256).alias("content_hash"), "n_chars"
    )
    pattern = F.concat("source", F.lit("_*.csv"))
    return C.copy_plan(both, both.where("n_chars < 5000"), "source", pattern, "2024-01-31")


NEW_CUSTOMERS = """
    new AS (
      SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
             CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment
      FROM customer WHERE c_nationkey <> 3
      UNION ALL SELECT c_custkey + 1000000000, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey = 5
    )
"""


def customers(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")


def new_customers(spark, d):
    now = customers(spark, d)
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    balance = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal"))
    kept = now.where("c_nationkey <> 3").select("c_custkey", balance.alias("c_acctbal"), segment.alias("c_mktsegment"))
    more = now.where("c_nationkey = 5").select(
        (F.col("c_custkey") + 1000000000).alias("c_custkey"), "c_acctbal", "c_mktsegment"
    )
    return kept.unionByName(more)


@query(
    "scd2_delta",
    f"""
    WITH {NEW_CUSTOMERS}
    SELECT coalesce(n.c_custkey, c.c_custkey) AS c_custkey, n.c_acctbal, n.c_mktsegment,
           CASE WHEN c.c_custkey IS NULL THEN 'insert' WHEN n.c_custkey IS NULL THEN 'expire' ELSE 'update' END AS change_type
    FROM customer c FULL OUTER JOIN new n ON c.c_custkey = n.c_custkey
    WHERE c.c_custkey IS NULL OR n.c_custkey IS NULL OR c.c_acctbal IS DISTINCT FROM n.c_acctbal
       OR c.c_mktsegment IS DISTINCT FROM n.c_mktsegment
    """,
)
def scd2_delta(spark, d):
    current = customers(spark, d).drop("c_nationkey")
    return C.scd2_delta(current, new_customers(spark, d), ["c_custkey"], ["c_acctbal", "c_mktsegment"])


@query(
    "scd2_dimension",
    f"""
    WITH {NEW_CUSTOMERS},
    m AS (SELECT c.c_custkey AS ck, n.c_custkey AS nk, c.c_acctbal AS ca, n.c_acctbal AS na, c.c_mktsegment AS cs,
                 n.c_mktsegment AS ns, c.c_acctbal IS DISTINCT FROM n.c_acctbal
                 OR c.c_mktsegment IS DISTINCT FROM n.c_mktsegment AS diff
          FROM customer c FULL OUTER JOIN new n ON c.c_custkey = n.c_custkey)
    SELECT c_custkey, c_acctbal, 'OLD' AS c_mktsegment, TIMESTAMP '2022-01-01' AS valid_from,
           TIMESTAMP '2023-01-01' AS valid_to, FALSE AS is_current FROM customer
    UNION ALL SELECT ck, ca, cs, TIMESTAMP '2023-01-01', CAST(NULL AS TIMESTAMP), TRUE FROM m WHERE ck IS NOT NULL AND nk IS NOT NULL AND NOT diff
    UNION ALL SELECT ck, ca, cs, TIMESTAMP '2023-01-01', TIMESTAMP '2024-01-31', FALSE FROM m WHERE ck IS NOT NULL AND (nk IS NULL OR diff)
    UNION ALL SELECT nk, na, ns, TIMESTAMP '2024-01-31', CAST(NULL AS TIMESTAMP), TRUE FROM m WHERE nk IS NOT NULL AND (ck IS NULL OR diff)
    """,
)
def scd2_dimension(spark, d):
    """A dimension with closed history, one load later."""
    now = customers(spark, d).drop("c_nationkey")
    opened = C.scd2_start(now, "2023-01-01")
    history = C.scd2_start(now.withColumn("c_mktsegment", F.lit("OLD")), "2022-01-01").withColumns(
        {"valid_to": F.lit("2023-01-01").cast("timestamp_ntz"), "is_current": F.lit(False)}
    )
    tracked = ["c_acctbal", "c_mktsegment"]
    return C.scd2_dimension(history.unionByName(opened), new_customers(spark, d), ["c_custkey"], tracked, "2024-01-31")


@query(
    "month_mismatch",
    """
    WITH a AS (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1),
    b AS (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders
          WHERE NOT (o_totalprice > 480000) AND o_orderdate < TIMESTAMP '2001-01-01' GROUP BY 1)
    SELECT strftime(a.month, '%Y-%m-%d') AS month, a.n AS old_rows, coalesce(b.n, 0) AS new_rows
    FROM a LEFT JOIN b USING (month) WHERE a.n <> coalesce(b.n, 0)
    """,
)
def month_mismatch_query(spark, d):
    orders = table(spark, d, "orders")
    new = orders.where("NOT (o_totalprice > 480000) AND o_orderdate < '2001-01-01'")
    return month_mismatch(orders, new, "o_orderdate").withColumn("month", F.col("month").cast("string"))


@query(
    "month_mismatch_both_sides",
    """
    WITH a AS (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders
               WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1),
    b AS (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1)
    SELECT strftime(b.month, '%Y-%m-%d') AS month, coalesce(a.n, 0) AS old_rows, b.n AS new_rows
    FROM b LEFT JOIN a USING (month) WHERE b.n <> coalesce(a.n, 0)
    """,
)
def month_mismatch_both_sides(spark, d):
    orders = table(spark, d, "orders")
    out = month_mismatch(orders.where("o_orderdate >= '1996-01-01'"), orders, "o_orderdate", both_sides=True)
    return out.withColumn("month", F.col("month").cast("string"))


@query("distinct_months", "SELECT DISTINCT strftime(o_orderdate, '%Y-%m-01') AS month FROM orders ORDER BY 1 DESC")
def distinct_months_query(spark, d):
    return distinct_months(table(spark, d, "orders"), "o_orderdate", descending=True)


@query(
    "reconcile_totals",
    "SELECT count(*) AS old_rows, count(*) FILTER (WHERE o_totalprice < 300000) AS new_rows, "
    "count(*) = count(*) FILTER (WHERE o_totalprice < 300000) AS is_equal FROM orders",
)
def reconcile_totals_query(spark, d):
    orders = table(spark, d, "orders")
    return reconcile_totals(orders, orders.where("o_totalprice < 300000"))


@query(
    "reconcile_content",
    "SELECT count(*) AS old_rows, count(*) AS new_rows, FALSE AS is_equal FROM orders",
)
def reconcile_content(spark, d):
    """Equal counts, one column changed: the content check tells."""
    orders = table(spark, d, "orders")
    return reconcile_totals(orders, orders.withColumn("o_totalprice", F.col("o_totalprice") + 1), content=True)


# Equal counts in every month; in one, some prices moved to other orders' rows.
CHANGED = """
    new AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + CASE WHEN o_orderkey % 7 = 0
            AND date_trunc('month', o_orderdate) = TIMESTAMP '1996-03-01' THEN 1 ELSE 0 END AS o_totalprice,
            o_orderdate, o_orderpriority FROM orders)
"""


def changed_orders(spark, d):
    orders = table(spark, d, "orders")
    hit = (F.col("o_orderkey") % 7 == 0) & (F.date_trunc("month", "o_orderdate") == F.lit("1996-03-01").cast("timestamp"))
    return orders, orders.withColumn("o_totalprice", F.col("o_totalprice") + F.when(hit, 1).otherwise(0))


@query(
    "content_mismatch",
    f"""
    WITH {CHANGED}
    SELECT strftime(o_orderdate, '%Y-%m-01') AS month, count(*) AS old_rows, count(*) AS new_rows
    FROM orders JOIN new USING (o_orderkey, o_orderdate) GROUP BY 1
    HAVING bool_or(orders.o_totalprice <> new.o_totalprice)
    """,
)
def content_mismatch_query(spark, d):
    """The month that differs, though its counts agree."""
    old, new = changed_orders(spark, d)
    found = content_mismatch(old, new, F.trunc("o_orderdate", "MM"))
    return found.select(F.col("part").cast("string").alias("month"), "old_rows", "new_rows")


@query(
    "row_differences",
    f"""
    WITH {CHANGED}, gone AS (SELECT * FROM orders EXCEPT ALL SELECT * FROM new), come AS (SELECT * FROM new EXCEPT ALL SELECT * FROM orders)
    SELECT *, CAST(1 AS BIGINT) AS old_rows, CAST(0 AS BIGINT) AS new_rows FROM gone
    UNION ALL SELECT *, CAST(0 AS BIGINT), CAST(1 AS BIGINT) FROM come
    """,
)
def row_differences_query(spark, d):
    """The changed rows themselves, in their old and their new form."""
    return row_differences(*changed_orders(spark, d))


# Suppliers stand for nodes; node n is computed from node n div 2.
EDGES = "edges AS (SELECT s_suppkey AS node_id, s_suppkey // 2 AS child_node_id FROM supplier WHERE s_suppkey > 0)"


def edges(spark, d):
    return table(spark, d, "supplier").where("s_suppkey > 0").selectExpr(
        "s_suppkey AS node_id", "s_suppkey DIV 2 AS child_node_id"
    )


@query(
    "lineage_stages",
    f"""
    WITH {EDGES}, nodes AS (SELECT node_id AS node FROM edges UNION SELECT child_node_id FROM edges)
    SELECT node, CASE WHEN node NOT IN (SELECT child_node_id FROM edges) THEN 'root'
                      WHEN node NOT IN (SELECT node_id FROM edges) THEN 'leaf' ELSE 'intermediate' END AS stage
    FROM nodes
    """,
)
def lineage_stages(spark, d):
    return lineage.stages(edges(spark, d))


@query(
    "lineage_closure",
    f"""
    WITH RECURSIVE {EDGES},
    r AS (SELECT node_id AS start, child_node_id AS node FROM edges
          WHERE node_id NOT IN (SELECT child_node_id FROM edges)
          UNION SELECT r.start, e.child_node_id FROM r JOIN edges e ON e.node_id = r.node)
    SELECT start, node FROM r
    """,
)
def lineage_closure(spark, d):
    """All that the end products (nodes that feed nothing) depend on."""
    e = edges(spark, d)
    return lineage.reachable(e, lineage.stages(e).where("stage = 'root'").select("node"))


@query(
    "lineage_impact",
    f"""
    WITH RECURSIVE {EDGES},
    r AS (SELECT child_node_id AS start, node_id AS node FROM edges WHERE child_node_id < 3
          UNION SELECT r.start, e.node_id FROM r JOIN edges e ON e.child_node_id = r.node)
    SELECT start, node FROM r
    """,
)
def lineage_impact(spark, d):
    e = edges(spark, d)
    sources = e.select(F.col("child_node_id").alias("node")).distinct().where("node < 3")
    return lineage.impact(e, sources)
