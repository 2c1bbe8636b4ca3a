"""Files that change, as a stream."""

import datetime as dt
import os
import uuid

import duckdb
import pytest
from pyspark.errors import PySparkException

from millrace.plans import exports
from millrace.plans.table import WarehouseTable, ensure_database
from millrace.session import scratch_dir
from millrace.sources import listing
from millrace.sources.files import read_files
from millrace.streaming.files import ingest_changed
from tests.compare import duck_rows, spark_rows
from warehouse_queries import ORACLE, QUERIES

SCHEMA = "v int, d timestamp_ntz"


@pytest.fixture
def db(spark):
    name = f"s_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, name, scratch_dir(spark, name))
    return name


def put(folder, name, values, at):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("v|d\n" + "".join(f"{v}|2024-01-05 00:00:00\n" for v in values))
    os.utime(path, (at, at))


def test_changed_files_are_loaded_again_by_path(spark, db, tmp_path):
    table, drop, state = WarehouseTable(spark, f"{db}.t", "d"), tmp_path / "in", scratch_dir(spark, "state")
    loads = []

    def read(paths):
        loads.append(sorted(p.rsplit("/", 2)[1] for p in paths))
        return read_files(spark, paths, "csv", True, True, schema=SCHEMA)

    def run():
        loads.clear()
        found = listing.list_directory(spark, str(drop), "*.csv", recursive=True)
        ingest_changed(found, table, state, read).awaitTermination()
        return loads[:], sorted(r.v for r in table.read().collect())

    put(drop, "a/o.csv", [1, 2], 1_700_000_000)
    put(drop, "b/o.csv", [3], 1_700_000_000)
    assert run() == ([["a", "b"]], [1, 2, 3])
    assert run() == ([], [1, 2, 3])
    put(drop, "a/o.csv", [4, 5], 1_700_000_100)
    put(drop, "c/o.csv", [6], 1_700_000_000)
    assert run() == ([["a", "c"]], [3, 4, 5, 6])
    # An older version that comes back is a change too; equal time and size are not.
    put(drop, "a/o.csv", [7, 8], 1_700_000_000)
    put(drop, "b/o.csv", [9], 1_700_000_000)
    assert run() == ([["a"]], [3, 6, 7, 8])


def test_a_load_that_dies_is_repeated(spark, db, tmp_path):
    table, drop, state = WarehouseTable(spark, f"{db}.t", "d"), tmp_path / "in", scratch_dir(spark, "state")
    put(drop, "a/o.csv", [1], 1_700_000_000)
    found = listing.list_directory(spark, str(drop), "*.csv", recursive=True)

    def dead(paths):
        raise RuntimeError("dead")

    with pytest.raises(PySparkException, match="dead"):
        ingest_changed(found, table, state, dead).awaitTermination()
    ingest_changed(found, table, state, lambda paths: read_files(spark, paths, "csv", True, True, schema=SCHEMA)).awaitTermination()
    assert [(r.v, r.d) for r in table.read().collect()] == [(1, dt.datetime(2024, 1, 5))]


def test_types_of_several_files_against_sql(spark, tmp_path, monkeypatch):
    """More rows of a type than a file takes, a type that loses all rows, one without a name."""
    monkeypatch.setattr(exports, "ROWS_PER_FILE", 4)
    types = ["view", "click", "a/b=c"]
    rows = [(i, dt.datetime(2024, 1, 20 + i % 9 if i % 3 == 0 else 1 + i % 28), i % 7, types[i % 3], i / 2, "{}") for i in range(45)]
    rows.append((45, dt.datetime(2024, 1, 3), 1, None, 0.5, None))
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    found = spark_rows(QUERIES["stream_changed_files"](spark, str(tmp_path)))
    assert found == duck_rows(con, ORACLE["stream_changed_files"])
    assert len(found[1]) == 31
