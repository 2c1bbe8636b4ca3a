"""Round trips: file sources and sinks, and warehouse tables."""

from __future__ import annotations

import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from millrace.operators.refresh import RefreshSpec
from millrace.plans import exports
from millrace.plans.sql import create_views
from millrace.plans.table import WarehouseTable
from millrace.session import delete_path, hadoop_path, scratch_dir
from millrace.sources import catalog, files, listing
from millrace.sources.spec import Source
from millrace.streaming.files import file_stream, ingest_changed, ingest_stream
from warehouse_queries.refreshes import BOUNDS_SQL, CDC_SQL, MONTH_SQL, march, three_days
from warehouse_queries.registry import new_database, query, table

PART = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"
ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


@query("parquet_roundtrip", ORDERS)
def parquet_roundtrip(spark, d):
    path = scratch_dir(spark, "parquet")
    exports.write_sink(table(spark, d, "orders"), "parquet", path)
    return files.read_parquet(spark, f"{path}/*.parquet")


@query("delimited_roundtrip", PART)
def delimited_roundtrip(spark, d):
    path = scratch_dir(spark, "part") + ".csv"
    exports.write_delimited(table(spark, d, "part"), path)
    out = files.read_delimited(spark, path)
    return out.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query("delimiter_fallback", PART)
def delimiter_fallback(spark, d):
    """Commas in the file, semicolons asked for."""
    path = scratch_dir(spark, "part") + ".csv"
    exports.write_delimited(table(spark, d, "part"), path, delimiter=",")
    out = files.read_delimited(spark, path, delimiter=";", auto_delimiter=True)
    return out.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query(
    "all_string_scan",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part",
)
def all_string_scan(spark, d):
    path = scratch_dir(spark, "part") + ".csv"
    exports.write_delimited(table(spark, d, "part"), path)
    return files.read_text_all(spark, path, "txt")


@query(
    "sampled_inference",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, "
    "CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'unknown' ELSE CAST(o_custkey AS VARCHAR) END AS late FROM orders",
)
def sampled_inference(spark, d):
    """Types by the looks of all values: one that does not fit, in the last row, keeps its column text."""
    path = scratch_dir(spark, "orders") + ".csv"
    orders = table(spark, d, "orders")
    top = orders.agg(F.max("o_orderkey")).scalar()
    late = F.when(F.col("o_orderkey") == top, "unknown").otherwise(F.col("o_custkey").cast("string"))
    exports.write_delimited(orders.withColumn("late", late), path)
    out = files.read_delimited(spark, path, infer_looks=True)
    casts = {c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")}
    return out.withColumns({**casts, "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz")})


@query(
    "multi_path_union",
    """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, CAST(NULL AS INTEGER) AS nation FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier
    """,
)
def multi_path_union(spark, d):
    """Two folders of text with different columns, one read."""
    root = scratch_dir(spark, "multi")
    customers = table(spark, d, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    suppliers = table(spark, d, "supplier").selectExpr("s_nationkey AS nation", "s_suppkey AS id", "s_name AS name")
    exports.write_delimited(customers, f"{root}/a.csv")
    exports.write_delimited(suppliers, f"{root}/b.csv")
    found = listing.list_directory(spark, root, "*.csv", recursive=True).orderBy("parent_path", "filename")
    paths = [f"{r['parent_path']}/{r['filename']}" for r in found.select("parent_path", "filename").collect()]
    out = files.read_files(spark, paths, "csv")
    return out.withColumn("id", F.col("id").cast("bigint"))


@query(
    "folder_mixed_headers",
    """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
    """,
)
def folder_mixed_headers(spark, d):
    """One folder of files whose columns stand in different orders, with different delimiters."""
    root = scratch_dir(spark, "mixed")
    customers = table(spark, d, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    suppliers = table(spark, d, "supplier").selectExpr("s_acctbal AS balance", "s_name AS name", "s_suppkey AS id")
    exports.write_delimited(customers, f"{root}/all.csv")
    exports.write_delimited(suppliers, f"{root}/all.csv", delimiter=",", mode="append")
    out = files.read_files(spark, f"{root}/all.csv", "csv", auto_delimiter=True)
    return out.withColumn("id", F.col("id").cast("bigint"))


@query(
    "parquet_glob_merge",
    """
    SELECT c_custkey AS id, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS name FROM customer
    UNION ALL SELECT s_suppkey, NULL, s_name FROM supplier
    """,
)
def parquet_glob_merge(spark, d):
    """Parquet files with different columns under one glob."""
    root = scratch_dir(spark, "merge")
    exports.write_parquet(table(spark, d, "customer").selectExpr("c_custkey AS id", "c_acctbal AS balance"), f"{root}/a")
    exports.write_parquet(table(spark, d, "supplier").selectExpr("s_suppkey AS id", "s_name AS name"), f"{root}/b")
    return files.read_files(spark, f"{root}/*/*.parquet", "parquet")


@query("encoding_choice", "SELECT doc_id, lang || ' é' AS lang, source FROM documents")
def encoding_choice(spark, d):
    """Latin-1 and UTF-8 files in one folder; each is read in the encoding that all its bytes say."""
    root = scratch_dir(spark, "encoding")
    docs = table(spark, d, "documents").select("doc_id", F.concat("lang", F.lit(" é")).alias("lang"), "source")
    for part, name in (("doc_id % 2 = 0", "ISO-8859-1"), ("doc_id % 2 = 1", "UTF-8")):
        docs.where(part).write.mode("append").options(header=True, sep="|", encoding=name).csv(f"{root}/all")
    return files.read_files(spark, f"{root}/all", "csv", encoding="auto").withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query("archive_fallback", "SELECT count(*) AS n_rows, TRUE AS from_archive FROM orders")
def archive_fallback(spark, d):
    """The first folder has no file of the pattern, so the archive is listed and read."""
    root = scratch_dir(spark, "archive")
    exports.write_parquet(table(spark, d, "orders"), f"{root}/archive")
    exports.write_delimited(table(spark, d, "region"), f"{root}/inbox.csv")
    inbox = listing.list_directory(spark, f"{root}/inbox.csv", "*.parquet")
    found = listing.list_with_fallback(inbox, listing.list_directory(spark, f"{root}/archive", "*.parquet"))
    paths = [f"{r['parent_path']}/{r['filename']}" for r in found.select("parent_path", "filename").collect()]
    rows = files.read_parquet(spark, paths).agg(F.count("*").alias("n_rows"))
    return rows.withColumn("from_archive", F.lit(all("/archive/" in p for p in paths)))


@query(
    "directory_listing",
    "SELECT strftime(o_orderdate, '%Y-%m-01') AS month, count(*) AS n_rows, 1 AS has_files FROM orders GROUP BY 1",
)
def directory_listing(spark, d):
    """The listing of a month backup beside the rows its files hold."""
    path = scratch_dir(spark, "backup")
    exports.backup_by_month(table(spark, d, "orders"), "o_orderdate", path)
    found = listing.list_directory(spark, path, "*.parquet", recursive=True)
    folders = found.groupBy(F.regexp_extract("parent_path", "month=(.*)$", 1).alias("month")).agg(
        (F.count("*") > 0).cast("int").alias("has_files")
    )
    rows = files.read_parquet(spark, f"{path}/month=*").select(
        F.regexp_extract(F.col("_metadata.file_path"), "month=([^/]*)/", 1).alias("month")
    )
    return rows.groupBy("month").agg(F.count("*").alias("n_rows")).join(folders, "month", "left")


def _level_sql(k: int) -> str:
    return f"""l{k} AS (SELECT month, n{k - 1} // 4096 AS n{k}, sha256(string_agg(h{k - 1}, '' ORDER BY n{k - 1})) AS h{k}
        FROM l{k - 1} GROUP BY 1, 2)"""


@query(
    "file_hashes",
    f"""
    WITH least AS (SELECT min(o_orderkey) AS k FROM orders),
    lines AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey,
        concat_ws('|', o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT),
                  strftime(o_orderdate, '%Y-%m-%d'), CASE WHEN o_orderkey = k THEN 'changed' ELSE o_orderpriority END) AS line
        FROM orders, least),
    l0 AS (SELECT month, row_number() OVER (PARTITION BY month ORDER BY o_orderkey) - 1 AS n0, sha256(line) AS h0 FROM lines),
    {", ".join(_level_sql(k) for k in range(1, 5))},
    sizes AS (SELECT month, CAST(sum(strlen(line) + 1) AS BIGINT) AS st_size FROM lines GROUP BY 1)
    SELECT month, st_size, sha256(st_size || ':' || h4) AS digest,
           month = (SELECT strftime(o_orderdate, '%Y-%m') FROM orders, least WHERE o_orderkey = k) AS is_changed
    FROM l4 JOIN sizes USING (month)
    """,
)
def file_hashes(spark, d):
    """One text file a month, then again with one order changed: the digests name the changed file."""
    orders = table(spark, d, "orders")
    least = orders.agg(F.min("o_orderkey")).scalar()

    def digests(priority):
        cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
        day = F.date_format("o_orderdate", "yyyy-MM-dd")
        line = F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", cents, day, priority)
        months = orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey", line.alias("line"))
        path = scratch_dir(spark, "hash")
        sorted_months = months.repartition("month").sortWithinPartitions("month", "o_orderkey")
        sorted_months.select("month", "line").write.partitionBy("month").text(path)
        found = listing.digest_files(spark, path, "*.txt", recursive=True)
        return found.select(F.substring_index("parent_path", "month=", -1).alias("month"), "st_size", "digest")

    before = digests(F.col("o_orderpriority")).select("month", F.col("digest").alias("old"))
    after = digests(F.when(F.col("o_orderkey") == least, F.lit("changed")).otherwise(F.col("o_orderpriority")))
    return after.join(before, "month", "left").withColumn("is_changed", ~F.col("digest").eqNullSafe(F.col("old"))).drop("old")


@query("month_backup_roundtrip", ORDERS)
def month_backup_roundtrip(spark, d):
    path = scratch_dir(spark, "backup")
    exports.backup_by_month(table(spark, d, "orders"), "o_orderdate", path)
    return files.read_parquet(spark, path).drop("month")


@query("memory_source", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0")
def memory_source(spark, d):
    """A callable as source."""

    def rich(session):
        return table(session, d, "supplier").where("s_acctbal > 0").select("s_suppkey", "s_name")

    return Source(rich, "memory").read(spark)


def orders_table(spark, d, **options):
    db = new_database(spark)
    target = WarehouseTable(spark, f"{db}.orders", "o_orderdate", **options)
    target.append(table(spark, d, "orders"))
    return target


@query("table_refresh_full", ORDERS + " WHERE o_totalprice > 100000")
def table_refresh_full(spark, d):
    target = orders_table(spark, d)
    target.refresh(target.read().where("o_totalprice > 100000"), RefreshSpec(refresh_type="FULL"))
    return target.read()


@query("table_refresh_month", MONTH_SQL)
def table_refresh_month(spark, d):
    target = orders_table(spark, d)
    spec = RefreshSpec(refresh_type="PARTITION_MTD", partition_value="1997-03-20")
    target.refresh(march(table(spark, d, "orders")), spec)
    return target.read()


@query("table_refresh_n_days", BOUNDS_SQL)
def table_refresh_n_days(spark, d):
    events = table(spark, d, "events")
    target = WarehouseTable(spark, f"{new_database(spark)}.events", "ts")
    target.append(events)
    target.refresh(three_days(events), RefreshSpec(refresh_type="PARTITION_N_DAYS"))
    return target.read()


@query("table_refresh_cdc", CDC_SQL)
def table_refresh_cdc(spark, d):
    """A table without partition column: the rows that stay and the batch become a new version."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars", F.col("source").alias("FILE_NAME"))
    target = WarehouseTable(spark, f"{new_database(spark)}.docs")
    target.append(docs)
    batch = docs.where("FILE_NAME LIKE 'src1%'").withColumn("n_chars", F.col("n_chars") + 1)
    target.refresh(batch, RefreshSpec(ingest_type="CDC"))
    return target.read()


@query(
    "table_refresh_cdc_partitioned",
    """
    WITH t AS (SELECT o_orderkey, o_orderdate, o_orderpriority AS FILE_NAME FROM orders)
    SELECT o_orderkey, o_orderdate, FILE_NAME FROM t WHERE FILE_NAME <> '1-URGENT'
    UNION ALL SELECT o_orderkey, o_orderdate, FILE_NAME FROM t
      WHERE FILE_NAME = '1-URGENT' AND o_orderdate >= TIMESTAMP '1997-01-01'
    """,
)
def table_refresh_cdc_partitioned(spark, d):
    """One file's rows spread over all months; months without new rows lose the old ones."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.col("o_orderpriority").alias("FILE_NAME"))
    target = WarehouseTable(spark, f"{new_database(spark)}.orders", "o_orderdate")
    target.append(rows)
    target.refresh(
        rows.where("FILE_NAME = '1-URGENT' AND o_orderdate >= '1997-01-01'"), RefreshSpec(ingest_type="CDC")
    )
    return target.read()


@query("table_delete", ORDERS + " WHERE NOT (o_orderdate < TIMESTAMP '1997-03-10' OR o_totalprice > 400000)")
def table_delete(spark, d):
    target = orders_table(spark, d)
    target.delete((F.col("o_orderdate") < "1997-03-10") | (F.col("o_totalprice") > 400000))
    return target.read()


@query(
    "table_upsert",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate FROM orders
    UNION ALL SELECT o_orderkey + 1000000000, o_totalprice, o_orderdate FROM orders WHERE o_orderpriority = '1-URGENT'
    """,
)
def table_upsert(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")
    columns = ["o_orderkey", "o_totalprice", "o_orderdate"]
    target = WarehouseTable(spark, f"{new_database(spark)}.orders", "o_orderdate", "YEARLY")
    target.append(rows.select(columns))
    changed = rows.where("o_orderstatus = 'P'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    new = rows.where("o_orderpriority = '1-URGENT'").withColumn("o_orderkey", F.col("o_orderkey") + 1000000000)
    target.upsert(changed.select(columns).unionByName(new.select(columns)), ["o_orderkey"])
    return target.read()


@query(
    "catalog_metadata",
    """
    SELECT 1 AS COLUMN_ID, 'o_orderkey' AS COL_NAME, 'bigint' AS DATA_TYPE, CAST(NULL AS INTEGER) AS MAX_LENGTH, CAST(NULL AS INTEGER) AS PRECISION, TRUE AS IS_NULLABLE, count(o_orderkey) AS n_filled FROM orders
    UNION ALL SELECT 2, 'o_price', 'decimal(18,2)', NULL, 18, TRUE, count(o_totalprice) FROM orders
    UNION ALL SELECT 3, 'o_orderstatus', 'string', -1, NULL, TRUE, count(o_orderstatus) FROM orders
    UNION ALL SELECT 4, 'o_orderdate', 'timestamp_ntz', NULL, NULL, TRUE, count(o_orderdate) FROM orders
    UNION ALL SELECT 5, 'SLICE_START', 'date', NULL, NULL, TRUE, count(o_orderdate) FROM orders
    """,
)
def catalog_metadata(spark, d):
    """Columns of a table as the catalog has them, beside the values that each holds."""
    price = F.col("o_totalprice").cast("decimal(18,2)").alias("o_price")
    target = WarehouseTable(spark, f"{new_database(spark)}.orders", "o_orderdate", text_limit=1)
    target.append(table(spark, d, "orders").select("o_orderkey", price, "o_orderstatus", "o_orderdate"))
    stored = spark.table(target.name)
    filled = stored.agg(*[F.count(c).alias(c) for c in stored.columns])
    counts = filled.unpivot([], stored.columns, "COL_NAME", "n_filled")
    return catalog.sink_metadata(spark, target.name).join(counts, "COL_NAME")


@query(
    "view_set",
    "SELECT o_orderpriority, count(*) AS n_orders, sum(CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END)::BIGINT AS n_big FROM orders GROUP BY 1",
)
def view_set(spark, d):
    """Views from query files, the second made from the first."""
    db = new_database(spark)
    with tempfile.TemporaryDirectory() as folder:
        texts = {
            "A_SIZED": f"SELECT o_orderpriority, o_totalprice > 100000 AS big FROM parquet.`{d}/orders.parquet`",
            "B_COUNTS": f"SELECT o_orderpriority, count(*) AS n_orders, count_if(big) AS n_big FROM {db}.A_SIZED GROUP BY 1",
        }
        for name, text in texts.items():
            Path(folder, f"{name}.sql").write_text(text)
        create_views(spark, folder, database=db)
    return spark.table(f"{db}.B_COUNTS")


@query(
    "table_pruned_scan",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-03-10' AND o_orderdate < TIMESTAMP '1997-06-05'",
)
def table_pruned_scan(spark, d):
    target = orders_table(spark, d)
    return target.scan("1997-03-10", "1997-06-05").select("o_orderkey", "o_orderdate")


@query("partition_purge_roundtrip", ORDERS + " WHERE NOT (o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01')")
def partition_purge_roundtrip(spark, d):
    from datetime import date

    target = orders_table(spark, d)
    target.purge(date(1997, 3, 17))
    return target.read()


@query("repartition_roundtrip", ORDERS)
def repartition_roundtrip(spark, d):
    """A table without slices rebuilt with monthly slices, counts checked, names swapped."""
    target = WarehouseTable(spark, f"{new_database(spark)}.orders")
    target.append(table(spark, d, "orders"))
    if not target.repartition("o_orderdate") or len(target.slices()) < 2:
        raise AssertionError("the rebuilt table differs")
    return target.read()


@query("swap_roundtrip", ORDERS)
def swap_roundtrip(spark, d):
    """A new version with other counts is refused; one with equal content takes the place."""
    db = new_database(spark)
    orders = table(spark, d, "orders")
    target, short, full = (WarehouseTable(spark, f"{db}.{n}", "o_orderdate") for n in ("orders", "short", "full"))
    target.append(orders)
    short.append(orders.where("o_totalprice > 100000"))
    full.append(orders)
    if target.swap_with(short) or not target.swap_with(full, content=True):
        raise AssertionError("wrong verdict")
    return target.read()


@query(
    "schema_evolution_roundtrip",
    "SELECT o_orderkey, o_orderdate, CAST(NULL AS VARCHAR) AS O_NOTE FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' "
    "UNION ALL SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'",
)
def schema_evolution_roundtrip(spark, d):
    from millrace.operators.schema import new_fields

    orders = table(spark, d, "orders")
    target = WarehouseTable(spark, f"{new_database(spark)}.orders", "o_orderdate")
    target.append(orders.where("o_orderdate < '1998-01-01'").select("o_orderkey", "o_orderdate"))
    later = orders.where("o_orderdate >= '1998-01-01'").select(
        "o_orderkey", "o_orderdate", F.col("o_orderpriority").alias("O_NOTE")
    )
    target.add_columns(new_fields(later, target.schema))
    target.append(later)
    return target.read()


@query("stream_ingest_roundtrip", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_ingest_roundtrip(spark, d):
    """Event files arrive in two waves, the second with one file delivered again."""
    root = scratch_dir(spark, "stream")
    events = table(spark, d, "events")
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    target = WarehouseTable(spark, f"{new_database(spark)}.events", "ts")
    for half in (F.col("ts") < middle, F.col("ts") >= middle):
        exports.write_parquet(events.where(half), f"{root}/in")
        stream = file_stream(spark, f"{root}/in", events.schema, max_files=1)
        ingest_stream(stream, target, f"{root}/checkpoint").awaitTermination()
    replay = file_stream(spark, f"{root}/in", events.schema)
    ingest_stream(replay, target, f"{root}/checkpoint-lost").awaitTermination()
    return target.read().drop("FILE_NAME", "FILE_PATH")


@query(
    "stream_changed_files",
    """
    SELECT event_id, ts, user_id, event_type, CASE WHEN event_type = 'click' AND ts >= TIMESTAMP '2024-01-10' THEN value + 1 ELSE value END AS value, props
    FROM events WHERE event_type <> 'view' OR ts < TIMESTAMP '2024-01-20'
    """,
)
def stream_changed_files(spark, d):
    """Files of each event type, of a bounded number of rows each, dealt by the event's id. Then those of two
    types change: one type gets other values, one loses rows.
    """
    root = scratch_dir(spark, "drop")
    target = WarehouseTable(spark, f"{new_database(spark)}.events", "ts")
    rows = table(spark, d, "events").withColumn("kind", F.coalesce(F.sha1("event_type"), F.lit("none")))
    parts = rows.groupBy("kind", "event_type").agg(F.ceil(F.count(F.lit(1)) / F.lit(exports.ROWS_PER_FILE)).alias("parts"))
    slots = {(r.kind, i): r.event_type for r in parts.collect() for i in range(r.parts)}
    part = F.pmod(F.xxhash64("event_id"), "parts").alias("part")
    events = rows.join(parts.select("kind", "parts"), "kind").select(*rows.columns, part)

    def deliver(rows, *types):
        """Whole files of fixed names for some types, else for all; one whose rows are all gone holds none."""
        whole = scratch_dir(spark, "delivery")
        rows = rows.where(F.col("event_type").isin(*types)) if types else rows
        rows.repartition("kind", "part").write.partitionBy("kind", "part").parquet(f"{whole}/rows")
        exports.write_parquet(rows.drop("kind", "part").limit(0), f"{whole}/none")
        (none,) = [f"{r.parent_path}/{r.filename}" for r in listing.list_directory(spark, f"{whole}/none", "*.parquet").collect()]
        made = {}
        for r in listing.list_directory(spark, f"{whole}/rows", "*.parquet", recursive=True).collect():
            kind, part = (name.split("=")[1] for name in r.parent_path.rsplit("/", 2)[1:])
            made[kind, int(part)] = f"{r.parent_path}/{r.filename}"
        for (kind, i), of in slots.items():
            if types and of not in types:
                continue
            fs, file = hadoop_path(spark, f"{root}/in/{kind}/{i}.parquet")
            fs.mkdirs(file.getParent())
            fs.delete(file, False)
            if (kind, i) in made:
                fs.rename(hadoop_path(spark, made[kind, i])[1], file)
            else:
                spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, hadoop_path(spark, none)[1], fs, file, False, spark._jsc.hadoopConfiguration())
        delete_path(spark, whole)

    def run():
        found = listing.list_directory(spark, f"{root}/in", "*.parquet", recursive=True)
        done = ingest_changed(found, target, f"{root}/state", lambda paths: files.read_files(spark, paths, "parquet", True, True))
        done.awaitTermination()
        return target.stored, target.files().agg(F.sum("rows")).first()[0]

    deliver(events)
    first = run()
    if run() != first:
        raise AssertionError("loaded again without a change")
    deliver(events.withColumn("value", F.when(F.col("ts") >= "2024-01-10", F.col("value") + 1).otherwise(F.col("value"))), "click")
    deliver(events.where("ts < '2024-01-20'"), "view")
    run()
    return target.read().drop("FILE_NAME", "FILE_PATH")
