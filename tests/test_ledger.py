"""Files known by path, and the ledger of their slices."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from millrace.context import RunContext
from millrace.operators.changes import new_files
from millrace.operators.refresh import RefreshSpec, refresh
from millrace.plans import jobs
from millrace.plans.table import WarehouseTable, ensure_database
from millrace.session import path_exists, scratch_dir
from millrace.sources import listing

CTX = RunContext("2024-01-20", "job", dt.datetime(2024, 2, 1))
READ = {"schema": "v int, d timestamp_ntz"}


@pytest.fixture
def db(spark):
    name = f"l_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, name, scratch_dir(spark, name))
    return name


def put(folder, name, values, day="2024-01-05"):
    (folder / name).parent.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("v|d\n" + "".join(f"{v}|{day} 00:00:00\n" for v in values))


def values(table):
    return sorted(r.V for r in table.read().collect())


@pytest.mark.parametrize("column", ["D", None])
def test_files_of_one_name_in_two_folders(spark, db, tmp_path, column):
    table, log = WarehouseTable(spark, f"{db}.t", column), WarehouseTable(spark, f"{db}.log")

    def run(**more):
        found = listing.list_directory(spark, str(tmp_path), "*.csv", recursive=True)
        return len(jobs.incremental_files_job(spark, found, log, table, CTX, "csv", read_options=READ, **more))

    put(tmp_path, "y=1996 a+b/orders.csv", [1, 2])
    assert run() == 1
    put(tmp_path, "y=1997/orders.csv", [3, 4], "2024-02-05")
    assert run() == 1 and values(table) == [1, 2, 3, 4]
    import os

    put(tmp_path, "y=1997/orders.csv", [5], "2024-03-05")
    os.utime(tmp_path / "y=1997/orders.csv", (2_000_000_000, 2_000_000_000))
    assert run() == 0
    assert run(reload_modified=True) == 1 and values(table) == [1, 2, 5]
    assert run() == 0
    held = {(r.file.split("/", 1)[-1].rsplit("/", 2)[-2], r.rows) for r in table.files().collect()}
    assert held == {("y=1996 a+b", 2), ("y=1997", 1)}


def rows(spark, months, name, path=None):
    made = [(m, dt.datetime(2024, m, 5), name, path) for m in months]
    return spark.createDataFrame(made, "k int, d timestamp_ntz, FILE_NAME string, FILE_PATH string")


def test_rows_without_a_path_go_by_name(spark, db):
    table = WarehouseTable(spark, f"{db}.t", "d")
    table.append(rows(spark, [1], "o.csv").union(rows(spark, [2], "o.csv", "file:/a/o.csv")).union(rows(spark, [3], "o.csv", "file:/b/o.csv")))
    new = rows(spark, [4], "o.csv", "file:/a/o.csv")
    expected = sorted(r.k for r in refresh(table.read(), new, RefreshSpec(ingest_type="CDC")).collect())
    table.refresh(new, RefreshSpec(ingest_type="CDC"))
    assert sorted(r.k for r in table.read().collect()) == expected == [3, 4]
    table.refresh(rows(spark, [5], "o.csv"), RefreshSpec(ingest_type="CDC", file_paths=["file:///b/o.csv"]))
    assert sorted(r.k for r in table.read().collect()) == [4, 5]
    table.refresh(rows(spark, [6], "o.csv"), RefreshSpec(ingest_type="CDC", file_names="o.csv"))
    assert sorted(r.k for r in table.read().collect()) == [6]


class Reads:
    """Slices whose files are opened: their files are made unreadable for all others."""

    def __init__(self, table, allowed):
        from pathlib import Path

        root = Path(table._location().removeprefix("file:"))
        for part in root.glob("SLICE_START=*"):
            if part.name.split("=")[1] not in allowed:
                for file in part.glob("*.parquet"):
                    file.write_bytes(b"")
                for crc in part.glob(".*.crc"):
                    crc.unlink()


def test_slices_without_hits_are_not_opened(spark, db):
    table = WarehouseTable(spark, f"{db}.t", "d")
    for month in range(1, 7):
        table.append(rows(spark, [month], f"f{month}.csv", f"file:/in/f{month}.csv"))
    table.append(rows(spark, [2], "f5.csv", "file:/in/f5.csv"))
    Reads(table, {"2024-02-01", "2024-05-01"})
    table.refresh(rows(spark, [9], "f5.csv", "file:/in/f5.csv"), RefreshSpec(ingest_type="CDC"))
    assert sorted(r.k for r in table.scan("2024-02-01", "2024-03-01").collect()) == [2]
    assert [str(s) for s in table.slices()] == ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01", "2024-06-01", "2024-09-01"]
    held = {(r.file, str(r.slice), r.rows) for r in table.files().where("file LIKE '%f5.csv' OR slice = '2024-02-01'").collect()}
    assert held == {("file:/in/f2.csv", "2024-02-01", 1), ("file:/in/f5.csv", "2024-09-01", 1)}


def test_new_files_open_nothing(spark, db):
    for column in ("d", None):
        table = WarehouseTable(spark, f"{db}.n{column}", column)
        table.append(rows(spark, [1, 2], "a.csv", "file:/a.csv"))
        stored = table.stored
        table.refresh(rows(spark, [3], "b.csv", "file:/b.csv"), RefreshSpec(ingest_type="CDC"))
        assert table.stored == stored and table.read().count() == 3


def test_a_run_that_dies_before_its_rows_is_repeated(spark, db):
    table = WarehouseTable(spark, f"{db}.t", "d")
    table.append(rows(spark, [1, 2, 3], "a.csv", "file:/a.csv"))
    new = rows(spark, [2, 7], "a.csv", "file:/a.csv")
    for point in ("_insert", "_drop_slice", "_settle"):
        again = WarehouseTable(spark, f"{db}.t")

        def die(*_, **__):
            raise RuntimeError("dead")

        setattr(again, point, die)
        with pytest.raises(RuntimeError, match="dead"):
            again.refresh(new if point != "_drop_slice" else rows(spark, [7], "a.csv", "file:/a.csv"), RefreshSpec(ingest_type="CDC"))
    table.refresh(new, RefreshSpec(ingest_type="CDC"))
    assert sorted(r.k for r in table.read().collect()) == [2, 7]
    assert {(str(r.slice), r.rows) for r in table.files().collect()} == {("2024-02-01", 1), ("2024-07-01", 1)}


def test_ledgers_come_and_go_with_their_version(spark, db):
    table = WarehouseTable(spark, f"{db}.t", "d")
    table.append(rows(spark, [1, 2], "a.csv", "file:/a.csv"))
    first = table._ledger().folder
    table.replace(rows(spark, [3, 4], "b.csv", "file:/b.csv"))
    assert not path_exists(spark, first) and [r.file for r in table.files().select("file").distinct().collect()] == ["file:/b.csv"]
    table.purge(dt.date(2024, 3, 1))
    assert [str(r.slice) for r in table.files().collect()] == ["2024-04-01"]
    table.refresh_slices(rows(spark, [4, 5], "c.csv", "file:/c.csv"))
    assert {(r.file, str(r.slice)) for r in table.files().collect()} == {("file:/c.csv", "2024-04-01"), ("file:/c.csv", "2024-05-01")}
    from millrace.session import delete_path

    delete_path(spark, table._ledger().folder)
    table.refresh(rows(spark, [8], "c.csv", "file:/c.csv"), RefreshSpec(ingest_type="CDC"))
    assert sorted(r.k for r in table.read().collect()) == [8]


def test_imported_paths_and_names(spark):
    found = spark.createDataFrame(
        [("file:/in/a", "o.csv", 1), ("file:///in/b", "o.csv", 1), ("/in/c", "p.csv", 1)], "parent_path string, filename string, st_size int"
    ).withColumn("last_modified_dt", F.lit(dt.datetime(2024, 1, 1)))
    nothing = found.where("false")
    known = spark.createDataFrame([("o.csv", "file:/in/b/o.csv"), ("p.csv", None)], "filename string, file_path string")
    assert [r.full_path for r in new_files(found, nothing, known).collect()] == ["file:/in/a/o.csv"]
    assert [r.full_path for r in new_files(found, nothing, known.select("filename")).collect()] == []
