"""Jobs end to end: source, table, refresh, logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from millrace.context import RunContext
from millrace.operators.refresh import RefreshSpec
from millrace.operators.relational import money_sum
from millrace.plans import exports, jobs
from millrace.plans.events import EventLog
from millrace.plans.table import WarehouseTable
from millrace.session import delete_path, hadoop_path, scratch_dir
from millrace.sources.files import read_files
from millrace.sources.listing import list_directory
from millrace.sources.spec import Source
from warehouse_queries.registry import new_database, query, table

CTX = RunContext("1997-03-20", "job-1", datetime(1997, 4, 1, 6, 0))
AUDIT = "'job-1' AS BATCH_JOB_ID, '1997-04-01 06:00:00' AS EDW_UPDATE_DTTM"

SALES = """
    SELECT o_orderdate, o_orderpriority, count(*) AS n_orders FROM sales_orders
    WHERE o_orderdate >= CAST('[[ first ]]' AS TIMESTAMP_NTZ) AND o_orderdate < CAST('[[ last ]]' AS TIMESTAMP_NTZ)
    GROUP BY o_orderdate, o_orderpriority
"""


def sales_source(spark, d, first, last):
    options = {"args": {"first": first, "last": last}, "refs": {"sales_orders": table(spark, d, "orders")}}
    return Source(SALES, "sql", options)


SALES_SQL = f"""
    SELECT o_orderdate AS O_ORDERDATE, o_orderpriority AS O_ORDERPRIORITY, count(*) AS N_ORDERS, {AUDIT} FROM orders
    GROUP BY ALL
"""


@query("job_transform", SALES_SQL)
def job_transform(spark, d):
    """All months loaded, then March loaded twice: the table stays the same."""
    target = WarehouseTable(spark, f"{new_database(spark)}.SALES", "O_ORDERDATE")
    jobs.transform_job(spark, sales_source(spark, d, "0001-01-01", "9999-01-01"), target, CTX)
    for _ in range(2):
        jobs.transform_job(spark, sales_source(spark, d, "1997-03-01", "1997-04-01"), target, CTX)
    return target.read()


@query(
    "event_rows",
    """
    SELECT 'job-1' AS BATCH_JOB_ID, '1997-03-20' AS RUN_DATE, 'REFRESH_DATA' AS EVENT_NAME, 'SUCCESS' AS EVENT_STAGE,
           'PARTITION_MTD' AS method, count(*) AS n_rows
    FROM (SELECT DISTINCT o_orderdate, o_orderpriority FROM orders
          WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01')
    UNION ALL SELECT 'job-1', '1997-03-20', 'REFRESH_DATA', 'FAILED', 'PARTITION_MTD', NULL
    """,
)
def event_rows(spark, d):
    """All months loaded, then one good run for March and one that fails, each with its event row."""
    db = new_database(spark)
    log = EventLog(spark, f"{db}.EVENTS")
    target = WarehouseTable(spark, f"{db}.SALES", "O_ORDERDATE")
    jobs.transform_job(spark, sales_source(spark, d, "0001-01-01", "9999-01-01"), target, CTX)
    source = sales_source(spark, d, "1997-03-01", "1997-04-01")
    jobs.transform_job(spark, source, target, CTX, events=log)

    def broken(df):
        raise ValueError("user transform failed")

    try:
        jobs.transform_job(spark, source, target, CTX, transforms=broken, events=log)
    except ValueError:
        pass
    data = "EVENT_DATA"
    return WarehouseTable(spark, log.name).read().select(
        "BATCH_JOB_ID",
        "RUN_DATE",
        "EVENT_NAME",
        "EVENT_STAGE",
        F.get_json_object(data, "$.refresh_method").alias("method"),
        F.get_json_object(data, "$.n_rows").cast("bigint").alias("n_rows"),
    )


def write_years(spark, d, path, condition="true"):
    """Text files of orders, one folder per year; a write of its own gives each year its own file names."""
    orders = table(spark, d, "orders").where(condition).select("o_orderkey", "o_totalprice", "o_orderdate")
    year = F.year("o_orderdate")
    for (y,) in orders.select(year.alias("y")).distinct().orderBy("y").collect():
        exports.write_delimited(orders.where(year == y), f"{path}/y={y}/orders.csv", mode="append")


def year_listing(spark, path):
    return list_directory(spark, path, "*.csv", recursive=True)


FILE_ORDERS = f"SELECT o_orderkey AS O_ORDERKEY, o_totalprice AS O_TOTALPRICE, o_orderdate AS O_ORDERDATE, {AUDIT} FROM orders"
READ = {"schema": "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz"}


@query("job_ingest", FILE_ORDERS.replace(" FROM", ", 'orders.csv' AS FILE_NAME FROM"))
def job_ingest(spark, d):
    """A file delivered twice is in the table once."""
    path = scratch_dir(spark, "orders") + ".csv"
    exports.write_delimited(table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate"), path)
    target = WarehouseTable(spark, f"{new_database(spark)}.ORDERS", "O_ORDERDATE")
    for _ in range(2):
        jobs.ingest_job(spark, Source(path, "csv", READ), target, CTX, RefreshSpec(ingest_type="CDC"), "orders.csv")
    return target.read()


@query("job_incremental_files", FILE_ORDERS)
def job_incremental_files(spark, d):
    """Files of the first years, then the others; a third run finds nothing."""
    db, root = new_database(spark), scratch_dir(spark, "inbox")
    target, log = WarehouseTable(spark, f"{db}.ORDERS", "O_ORDERDATE"), WarehouseTable(spark, f"{db}.FILE_LOG")
    for condition in ("o_orderdate < '1997-01-01'", "o_orderdate >= '1997-01-01'"):
        write_years(spark, d, root, condition)
        while jobs.incremental_files_job(spark, year_listing(spark, root), log, target, CTX, "csv", read_options=READ):
            pass
    again = jobs.incremental_files_job(spark, year_listing(spark, root), log, target, CTX, "csv", read_options=READ)
    if again:
        raise AssertionError(f"loaded again: {again}")
    return target.read().drop("FILE_NAME", "FILE_PATH")


@query(
    "job_same_names",
    f"""
    SELECT o_orderkey AS O_ORDERKEY, o_totalprice AS O_TOTALPRICE, o_orderdate AS O_ORDERDATE, {AUDIT}, year(o_orderdate) AS YEAR FROM orders
    WHERE year(o_orderdate) <> 1995 OR o_orderdate >= TIMESTAMP '1995-07-01'
    """,
)
def job_same_names(spark, d):
    """One folder a year, each with an ``orders.csv``; one of them is delivered again, shorter."""
    db, root = new_database(spark), scratch_dir(spark, "years")
    target, log = WarehouseTable(spark, f"{db}.ORDERS", "O_ORDERDATE"), WarehouseTable(spark, f"{db}.FILE_LOG")
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    year = F.year("o_orderdate")

    def deliver(y, condition):
        whole = f"{scratch_dir(spark, 'delivery')}.csv"
        exports.write_delimited(orders.where((year == y) & F.expr(condition)), whole, single_file=True)
        (part,) = [r.filename for r in list_directory(spark, whole, "*.csv").collect()]
        fs, folder = hadoop_path(spark, f"{root}/y={y}")
        fs.mkdirs(folder)
        delete_path(spark, f"{root}/y={y}/orders.csv")
        fs.rename(hadoop_path(spark, f"{whole}/{part}")[1], hadoop_path(spark, f"{root}/y={y}/orders.csv")[1])

    def load():
        return len(jobs.incremental_files_job(spark, year_listing(spark, root), log, target, CTX, "csv", reload_modified=True, read_options=READ))

    years = [r.y for r in orders.select(year.alias("y")).distinct().orderBy("y").collect()]
    for y in years:
        deliver(y, "true")
        if load() != 1:
            raise AssertionError(f"not loaded: {y}")
    deliver(1995, "o_orderdate >= '1995-07-01'")
    if load() != 1:
        raise AssertionError("not loaded again")
    held = target.files().groupBy("file").agg(F.sum("rows")).count()
    if held != len(years):
        raise AssertionError(f"files in the ledger: {held}")
    return target.read().withColumn("YEAR", F.regexp_extract("FILE_PATH", "y=([0-9]*)", 1).cast("bigint")).drop("FILE_NAME", "FILE_PATH")


@query("job_changed_batch", FILE_ORDERS)
def job_changed_batch(spark, d):
    """All files load together when one is new; unchanged content loads nothing."""
    db, root = new_database(spark), scratch_dir(spark, "drive")
    target, log = WarehouseTable(spark, f"{db}.ORDERS", "O_ORDERDATE"), WarehouseTable(spark, f"{db}.FILE_LOG")
    loaded = []
    for condition in ("o_orderdate < '1997-01-01'", "o_orderdate >= '1997-01-01'", "false"):
        write_years(spark, d, root, condition)
        loaded.append(
            jobs.changed_files_job(spark, year_listing(spark, root), log, target, CTX, "csv", read_options=READ)
        )
    if loaded[1] <= loaded[0] or loaded[2] != 0:
        raise AssertionError(f"rows loaded: {loaded}")
    return target.read().drop("FILE_NAME", "FILE_PATH")


@query("job_changed_file", FILE_ORDERS)
def job_changed_file(spark, d):
    """One master file: loaded, skipped while it is the same, loaded again when forced."""
    db, root = new_database(spark), scratch_dir(spark, "drive")
    exports.write_delimited(
        table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate"), f"{root}/m.csv", single_file=True
    )
    target, log = WarehouseTable(spark, f"{db}.ORDERS", "O_ORDERDATE"), WarehouseTable(spark, f"{db}.FILE_LOG")
    spec = RefreshSpec(ingest_type="MASTERDATA")
    found = list_directory(spark, f"{root}/m.csv", "*.csv")
    loaded = [
        jobs.changed_files_job(spark, found, log, target, CTX, "csv", spec, force, read_options=READ)
        for force in (False, False, True)
    ]
    if loaded[1] != 0 or loaded[0] != loaded[2]:
        raise AssertionError(f"rows loaded: {loaded}")
    return target.read().drop("FILE_NAME", "FILE_PATH")


@query("job_logged_files", "SELECT y || '' AS year, count(*) AS n_lines FROM (SELECT year(o_orderdate) AS y FROM orders) WHERE y <> 1996 GROUP BY y")
def job_logged_files(spark, d):
    """Files another process logged, one of them already loaded: the rest is loaded and counted."""
    db, root = new_database(spark), scratch_dir(spark, "legacy")
    write_years(spark, d, root)
    found = year_listing(spark, root)
    done = found.where(F.col("parent_path").contains("y=1996"))
    target = WarehouseTable(spark, f"{db}.ORDERS", "O_ORDERDATE")
    rows = jobs.logged_files_job(spark, found, done, target, CTX, "csv", read_options=READ)
    year = F.regexp_extract("parent_path", "y=([0-9]*)", 1).alias("year")
    return rows.groupBy(year).agg(F.sum("n_lines").alias("n_lines"))


@query(
    "job_two_steps",
    f"""
    SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS MONTH, l_returnflag AS L_RETURNFLAG,
           CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS REVENUE, {AUDIT}
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-04-01' GROUP BY ALL
    """,
)
def job_two_steps(spark, d):
    db = new_database(spark)
    staging, target = WarehouseTable(spark, f"{db}.STG_SALES"), WarehouseTable(spark, f"{db}.SALES", "MONTH")
    lines = table(spark, d, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    source = Source(lambda: lines.select("l_shipdate", "l_returnflag", net.alias("net")), "memory")

    def build(df):
        month = F.trunc("L_SHIPDATE", "MM").cast("timestamp_ntz").alias("MONTH")
        df = df.where("L_SHIPDATE >= '1997-03-01' AND L_SHIPDATE < '1997-04-01'")
        return df.groupBy(month, "L_RETURNFLAG").agg(money_sum(F.col("NET")).alias("REVENUE"))

    for _ in range(2):
        jobs.two_step_job(spark, source, staging, build, target, CTX)
    return target.read()


@query("job_history_load", FILE_ORDERS)
def job_history_load(spark, d):
    """A bulk load over months that are partly there: each month in the file replaces the month in the table."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    target = WarehouseTable(spark, f"{new_database(spark)}.ORDERS", "O_ORDERDATE")
    for part in ("o_totalprice < 200000", "true"):
        jobs.history_job(spark, Source(lambda part=part: orders.where(part), "memory"), target, CTX)
    return target.read()


@query("month_driver", FILE_ORDERS + " WHERE NOT (o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-05-01')")
def month_driver(spark, d):
    """All months loaded, then two run dates whose months the source no longer has: they are emptied."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    target = WarehouseTable(spark, f"{new_database(spark)}.ORDERS", "O_ORDERDATE")
    jobs.history_job(spark, Source(lambda: orders, "memory"), target, CTX)
    later = orders.where("o_orderdate >= '1998-01-01'")
    dates = spark.sql("SELECT explode(sequence(DATE'1997-03-31', DATE'1997-04-30', INTERVAL 1 MONTH)) AS run_date")
    jobs.history_job(spark, Source(lambda: later, "memory"), target, CTX, run_dates=dates)
    return target.read()


@query(
    "job_mirror",
    f"SELECT c_custkey AS C_CUSTKEY, c_name AS C_NAME, c_nationkey AS C_NATIONKEY, c_acctbal AS C_ACCTBAL, "
    f"c_mktsegment AS C_MKTSEGMENT, {AUDIT} FROM customer",
)
def job_mirror(spark, d):
    target = WarehouseTable(spark, f"{new_database(spark)}.CUSTOMER")
    source = Source(f"{d}/customer.parquet", "parquet")
    for _ in range(2):
        jobs.mirror_job(spark, source, target, CTX)
    return target.read()


@query(
    "job_backup",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'",
)
def job_backup(spark, d):
    path = scratch_dir(spark, "backup")
    source = Source(f"{d}/orders.parquet", "parquet")
    jobs.backup_job(spark, source, path, "o_orderdate", "1997-01-01", "1998-01-01")
    return read_files(spark, path, "parquet").select("o_orderkey", "o_orderdate")


@query(
    "job_export",
    "SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY 1",
)
def job_export(spark, d):
    path = scratch_dir(spark, "export") + "/report.csv"
    source = sales_source(spark, d, "0001-01-01", "9999-01-01")
    jobs.export_job(spark, source, path, CTX)
    out = read_files(spark, path, "csv")
    return out.groupBy("o_orderpriority").agg(F.sum("n_orders").alias("n_orders"))


@query(
    "job_run_log",
    f"""
    SELECT event_id AS EVENT_ID, user_id AS USER_ID, ts AS TS, min(ts) OVER (PARTITION BY user_id) AS GROUP_START,
           max(ts) OVER (PARTITION BY user_id) AS GROUP_END, {AUDIT} FROM events
    """,
)
def job_run_log(spark, d):
    """Events as task runs of a user; loading the same days twice changes nothing."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts")
    target = WarehouseTable(spark, f"{new_database(spark)}.RUN_LOG", "TS")
    for _ in range(2):
        jobs.run_log_job(events, target, CTX, "user_id", "ts", "ts", "TS")
    return target.read()
