"""Jobs: policies, audit, logs, modes, views."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from millrace.context import RunContext
from millrace.operators.refresh import RefreshSpec
from millrace.operators.schema import SchemaPolicy
from millrace.plans import jobs
from millrace.plans.events import EventLog
from millrace.plans.sql import create_views, load_sql, render, run_sql
from millrace.plans.table import WarehouseTable, ensure_database
from millrace.session import scratch_dir
from millrace.sources.listing import list_directory
from millrace.sources.spec import Source

CTX = RunContext("2024-01-20", "b-1", dt.datetime(2024, 2, 1, 6), "test", ("nightly",))
AUDIT = ["BATCH_JOB_ID", "EDW_UPDATE_DTTM"]


@pytest.fixture
def db(spark):
    name = f"j_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, name, scratch_dir(spark, name))
    return name


def rows(spark, data, ddl="`the id` int, d timestamp_ntz, note string"):
    return Source(lambda: spark.createDataFrame(data, ddl), "memory")


JAN, FEB = dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 5)


def test_default_refresh_is_the_run_dates_month(spark, db):
    t = WarehouseTable(spark, f"{db}.T", "D")
    jobs.transform_job(spark, rows(spark, [(1, JAN, "a"), (2, FEB, "b")]), t, CTX)
    assert jobs.transform_job(spark, rows(spark, [(3, JAN, "c")]), t, CTX) == 1
    assert t.read().columns == ["THE_ID", "D", "NOTE", *AUDIT]
    assert sorted(r["THE_ID"] for r in t.read().collect()) == [2, 3]
    assert {r["EDW_UPDATE_DTTM"] for r in t.read().collect()} == {"2024-02-01 06:00:00"}


def test_new_columns_are_ignored_added_or_kept(spark, db):
    t = WarehouseTable(spark, f"{db}.T", "D")
    jobs.transform_job(spark, rows(spark, [(1, FEB, "a")]), t, CTX)
    wider = rows(spark, [(2, JAN, "b", 1.5)], "`the id` int, d timestamp_ntz, note string, price double")
    jobs.transform_job(spark, wider, t, CTX)
    assert "PRICE" not in t.read().columns
    jobs.transform_job(spark, wider, t, CTX, policy=SchemaPolicy(evolve=True))
    assert dict(t.read().dtypes)["PRICE"] == "decimal(30,8)"
    assert sorted((r["THE_ID"], r["PRICE"] and float(r["PRICE"])) for r in t.read().collect()) == [(1, None), (2, 1.5)]


def test_full_refresh_keeps_old_columns_unless_told(spark, db):
    t = WarehouseTable(spark, f"{db}.T", "D")
    full = RefreshSpec(refresh_type="full")
    jobs.transform_job(spark, rows(spark, [(1, JAN, "a")]), t, CTX)
    slim = rows(spark, [(2, JAN, 7)], "`the id` int, d timestamp_ntz, fresh int")
    jobs.transform_job(spark, slim, t, CTX, full)
    assert set(t.read().columns) == {"THE_ID", "D", "NOTE", "FRESH", *AUDIT}
    jobs.transform_job(spark, slim, t, CTX, full, keep_old_columns=False)
    assert set(t.read().columns) == {"THE_ID", "D", "FRESH", *AUDIT}


def test_transform_list_is_not_changed(spark, db):
    t = WarehouseTable(spark, f"{db}.T", "D")
    steps = [lambda df: df.withColumn("NOTE", F.upper("NOTE"))]
    jobs.transform_job(spark, rows(spark, [(1, JAN, "a")]), t, CTX, transforms=steps)
    assert len(steps) == 1
    assert t.read().first()["NOTE"] == "A"


def test_event_rows(spark, db):
    t, log = WarehouseTable(spark, f"{db}.T", "D"), EventLog(spark, f"{db}.EVENTS")
    jobs.transform_job(spark, rows(spark, [(1, JAN, "a")]), t, CTX, events=log)
    with pytest.raises(ValueError, match="broken"):
        jobs.transform_job(spark, Source(lambda: (_ for _ in ()).throw(ValueError("broken")), "memory"), t, CTX, events=log)
    seen = spark.table(log.name).orderBy("LOG_DTTM").collect()
    assert [(r["EVENT_STAGE"], r["TABLE_NAME"], r["ENVIRONMENT_NAME"]) for r in seen] == [
        ("SUCCESS", f"{db}.T", "test"), ("FAILED", f"{db}.T", "test"),
    ]
    assert json.loads(seen[0]["EVENT_DATA"]) == {
        "source_tables": [], "source_format": "memory", "refresh_method": "PARTITION_MTD", "n_rows": 1, "tags": ["nightly"],
    }


def write(folder, name, body):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(body)


def incremental(spark, folder, db, t, **options):
    found = list_directory(spark, str(folder), "*.csv")
    log = WarehouseTable(spark, f"{db}.LOG")
    loaded = jobs.incremental_files_job(spark, found, log, t, CTX, "csv", **options)
    return [p.rsplit("/", 1)[-1] for p in loaded]


def test_incremental_files_in_capped_runs(spark, db, tmp_path):
    t = WarehouseTable(spark, f"{db}.T")
    for i in range(3):
        write(tmp_path, f"f{i}.csv", f"id|v\n{i}|x\n")
    assert incremental(spark, tmp_path, db, t, cap=2) == ["f0.csv", "f1.csv"]
    write(tmp_path, "f3.csv", "v|id|more\ny|3|z\n")
    assert incremental(spark, tmp_path, db, t) == ["f2.csv", "f3.csv"]
    assert incremental(spark, tmp_path, db, t) == []
    assert sorted((r["ID"], r["FILE_NAME"]) for r in t.read().collect()) == [(i, f"f{i}.csv") for i in range(4)]
    assert incremental(spark, tmp_path, db, t, pattern="f1", force_rerun=True) == []
    assert incremental(spark, tmp_path, db, t, pattern="f1", force_rerun=True, reload_modified=True) == ["f1.csv"]
    assert t.read().count() == 4


def test_month_and_masterdata_take_the_newest_file(spark, db, tmp_path):
    for i in (1, 2):
        write(tmp_path, f"f{i}.csv", f"id|d\n{i}|2024-01-0{i}\n")
    month = WarehouseTable(spark, f"{db}.M", "D")
    assert incremental(spark, tmp_path, db, month, ingest_type="MTD") == ["f2.csv"]
    other = f"{db}2"
    ensure_database(spark, other, scratch_dir(spark, other))
    master = WarehouseTable(spark, f"{other}.M")
    assert incremental(spark, tmp_path, other, master, ingest_type="MASTERDATA") == ["f2.csv"]
    assert [r["ID"] for r in master.read().collect()] == [2]


def test_views_and_sql_files(spark, db, tmp_path):
    write(tmp_path / "sql", "TOP_N.sql", "SELECT id FROM range(5) WHERE id > 2")
    assert create_views(spark, tmp_path) == ["TOP_N"]
    assert spark.table("TOP_N").count() == 2
    spark.catalog.dropTempView("TOP_N")
    assert create_views(spark, tmp_path, database=db) == [f"{db}.TOP_N"]
    assert spark.table(f"{db}.TOP_N").count() == 2
    assert load_sql(tmp_path, "TOP_N.sql").startswith("SELECT")
    with pytest.raises(FileNotFoundError):
        load_sql(tmp_path, "NO.sql")


def test_sql_arguments(spark):
    assert render("d = '[[ run_date ]]'", {"run_date": "2024-01"}) == "d = '2024-01-01'"
    out = run_sql(
        spark, "SELECT f_date(DATE'[[ run_date ]]') AS d, eomonth(DATE'2024-01-15', :k) AS e FROM t",
        {"run_date": "2024-01"}, {"t": spark.range(1)}, {"k": -1},
    ).first()
    assert tuple(out) == ("2024-01-01", dt.date(2023, 12, 31))
