"""Warehouse tables: slices, commits, failures, versions."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.refresh import RefreshSpec
from millrace.plans.table import SLICE, WarehouseTable, ensure_database
from millrace.session import path_exists, scratch_dir

DDL = "k int, d timestamp_ntz, FILE_NAME string"


def day(text):
    return dt.datetime.fromisoformat(text)


ROWS = [
    (1, day("2024-01-05"), "a"),
    (2, day("2024-01-31 23:59:59.5"), "b"),
    (3, day("2024-02-01"), "a"),
    (4, None, "c"),
]


@pytest.fixture
def db(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, name, scratch_dir(spark, name))
    return name


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def make(spark, db, name="t", column="d", **options):
    t = WarehouseTable(spark, f"{db}.{name}", column, **options)
    t.append(frame(spark, ROWS))
    return t


def keys(t):
    return sorted(r["k"] for r in t.read().collect())


def test_names_need_one_dot(spark):
    for bad in ("t", "a.b.c", ".t"):
        with pytest.raises(ValueError, match="SCHEMA.TABLE"):
            WarehouseTable(spark, bad)


def test_created_on_first_load_and_found_again(spark, db):
    t = WarehouseTable(spark, f"{db}.t", "d", "YEARLY")
    spec = RefreshSpec(refresh_type="PARTITION_MTD", partition_value="2024-01-01")
    assert t.refresh(frame(spark, ROWS), spec) == 4
    again = WarehouseTable(spark, f"{db}.t")
    assert (again.partition_column, again.interval) == ("d", "YEARLY")
    assert again.read().columns == ["k", "d", "FILE_NAME"]
    assert set(again.slices()) == {dt.date(2024, 1, 1), None}


def test_month_refresh_twice(spark, db):
    t = make(spark, db)
    batch = frame(spark, [(10, day("2024-01-07"), "x")])
    spec = RefreshSpec(refresh_type="PARTITION_MTD", partition_value="2024-01-20")
    for _ in range(2):
        assert t.refresh(batch, spec) == 1
        assert keys(t) == [3, 4, 10]


def test_batch_rows_outside_the_slice_join_their_month(spark, db):
    t = make(spark, db)
    batch = frame(spark, [(10, day("2024-02-07"), "x"), (11, None, "x")])
    t.refresh(batch, RefreshSpec(refresh_type="PARTITION_MTD", partition_value="2024-01-20"))
    assert keys(t) == [3, 4, 10, 11]
    assert set(t.slices()) == {dt.date(2024, 2, 1), None}


def test_emptied_slice_loses_its_files(spark, db):
    t = make(spark, db)
    where = f"{t._location(t.name)}/{SLICE}=2024-01-01"
    assert path_exists(spark, where)
    t.refresh(frame(spark, []), RefreshSpec(refresh_type="PARTITION_MTD", partition_value="2024-01-20"))
    assert keys(t) == [3, 4]
    assert not path_exists(spark, where)


def test_partial_hits_keep_the_rest_of_the_slice(spark, db):
    t = make(spark, db)
    spec = RefreshSpec(refresh_type="PARTITION_N_DAYS", partition_value="2024-01-06", n_days=2)
    t.refresh(frame(spark, []), spec)
    assert keys(t) == [2, 3, 4]


def test_files_across_months_and_null_month(spark, db):
    t = make(spark, db)
    t.refresh(frame(spark, [(10, day("2024-03-01"), "a"), (11, None, "c")]), RefreshSpec(ingest_type="CDC"))
    assert keys(t) == [2, 10, 11]
    t.refresh(frame(spark, [(12, day("2024-03-02"), "c")]), RefreshSpec(ingest_type="CDC"))
    assert keys(t) == [2, 10, 12]
    assert None not in t.slices()


def test_more_files_than_a_short_list(spark, db):
    t = WarehouseTable(spark, f"{db}.t", "d")
    many = spark.range(1500).select(
        F.col("id").cast("int").alias("k"), F.lit(day("2024-01-01")).cast("timestamp_ntz").alias("d"),
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("FILE_NAME"),
    )
    t.append(many)
    assert t.refresh(many.where("k < 1200"), RefreshSpec(ingest_type="CDC")) == 1200
    assert t.read().count() == 1500


def test_wide_value_refresh_on_another_column(spark, db):
    t = make(spark, db)
    spec = RefreshSpec(refresh_type="PARTITION", partition_column="FILE_NAME", partition_value="a")
    t.refresh(frame(spark, [(10, day("2024-02-03"), "a")]), spec)
    assert keys(t) == [2, 4, 10]


def test_full_refresh_changes_schema_and_removes_old_files(spark, db):
    t = make(spark, db)
    old = t._location(t.name)
    t.refresh(t.read().withColumn("more", F.lit(1)), RefreshSpec(refresh_type="FULL"))
    assert t.read().columns == ["k", "d", "FILE_NAME", "more"]
    assert keys(t) == [1, 2, 3, 4]
    assert not path_exists(spark, old)
    assert [x.name for x in spark.catalog.listTables(db) if not x.isTemporary] == ["t"]


@pytest.mark.parametrize("mode", ["PARTITION_MTD", "FULL"])
def test_failed_write_leaves_the_table_as_it_was(spark, db, mode):
    t = make(spark, db)
    broken = frame(spark, [(10, day("2024-01-07"), "x")]).withColumn(
        "k", F.when(F.col("k") == 10, F.raise_error(F.lit("boom")).cast("int"))
    )
    with pytest.raises(Exception, match="boom"):
        t.refresh(broken, RefreshSpec(refresh_type=mode, partition_value="2024-01-20"), staged=True)
    assert keys(t) == [1, 2, 3, 4]


def test_delete_and_upsert(spark, db):
    t = make(spark, db)
    t.delete(F.col("d") < "2024-01-10")
    assert keys(t) == [2, 3, 4]
    t.upsert(frame(spark, [(3, day("2024-04-01"), "moved"), (9, day("2024-04-02"), "new"), (4, None, "z")]), ["k"])
    assert keys(t) == [2, 3, 4, 9]
    assert t.read().where("k = 3").first()["FILE_NAME"] == "moved"
    assert dt.date(2024, 2, 1) not in t.slices()


def test_upsert_without_slices_keeps_last_record(spark, db):
    t = make(spark, db, column=None)
    batch = frame(spark, [(1, day("2024-01-01"), "x"), (1, day("2024-01-02"), "y")])
    t.upsert(batch, ["k"], ["d"])
    assert keys(t) == [1, 2, 3, 4]
    assert t.read().where("k = 1").first()["FILE_NAME"] == "y"


def test_purge_null_slice(spark, db):
    t = make(spark, db)
    t.purge(None)
    assert keys(t) == [1, 2, 3]


def test_required_columns_are_remembered(spark, db):
    t = WarehouseTable(spark, f"{db}.t", "d")
    t.create(T.StructType.fromDDL("k int not null, d timestamp_ntz"))
    assert [f.nullable for f in WarehouseTable(spark, f"{db}.t").schema.fields] == [False, True]


@pytest.mark.parametrize("interval", ["DAILY", "WEEKLY", "MONTHLY", "YEARLY"])
def test_intervals_give_the_same_result(spark, db, interval):
    t = make(spark, db, interval=interval)
    spec = RefreshSpec(refresh_type="PARTITION_MTD", partition_value="2024-01-20")
    t.refresh(frame(spark, [(10, day("2024-01-29"), "x")]), spec)
    assert keys(t) == [3, 4, 10]
    assert sorted(r["k"] for r in t.scan("2024-01-01", "2024-02-02").collect()) == [3, 10]


def test_interrupted_repartition_goes_on(spark, db):
    t = make(spark, db, column=None)
    half = WarehouseTable(spark, f"{db}.t_TEMP", "d")
    half.create(t.schema)
    half.append(frame(spark, ROWS[:1] + [(7, day("2024-05-01"), "stale")]))
    assert t.repartition("d")
    assert keys(t) == [1, 2, 3, 4]
    assert t.partition_column == "d"


def test_empty_batches(spark, db):
    t = make(spark, db)
    assert t.append(frame(spark, [])) == 0
    staged = t.read().where("k > 99")
    assert t.append(staged) == 0 and t.refresh_slices(staged) == 0
    assert t.refresh_slices(staged, [dt.date(2024, 2, 1)]) == 0 and keys(t) == [1, 2, 4]
    assert t.replace(staged) == 0 and keys(t) == []


def began(spark, db, rows, interval="MONTHLY", column="d", schema=None):
    half = WarehouseTable(spark, f"{db}.t_TEMP", column, interval)
    half.create(schema or frame(spark, ROWS).schema)
    half.append(frame(spark, rows))
    return half


@pytest.mark.parametrize("interval", ["DAILY", "WEEKLY", "MONTHLY", "YEARLY"])
def test_resumed_repartition_mends_equal_counts(spark, db, interval):
    t = make(spark, db, column=None)
    changed = [(k + 100, *rest) if k == 2 else (k, *rest) for k, *rest in ROWS]
    began(spark, db, changed, interval)
    assert t.repartition("d", interval)
    assert keys(t) == [1, 2, 3, 4] and t.interval == interval


def test_resumed_repartition_drops_rows_without_a_date(spark, db):
    t = make(spark, db, column=None)
    t.delete(F.col("d").isNull())
    began(spark, db, [*ROWS, (9, None, "x")])
    left = keys(t)
    assert t.repartition("d") and keys(t) == left


def test_repartition_begun_otherwise_begins_anew(spark, db):
    t = make(spark, db, column=None)
    began(spark, db, ROWS, "YEARLY")
    assert t.repartition("d", "DAILY")
    assert keys(t) == [1, 2, 3, 4] and t.interval == "DAILY"


def test_refused_swap_keeps_the_table(spark, db):
    t, other = make(spark, db), make(spark, db, "other")
    other.append(frame(spark, ROWS[:1]))
    assert not t.swap_with(other)
    assert keys(t) == [1, 2, 3, 4]


def test_many_months_replaced_in_one_job(spark, db):
    t = make(spark, db)
    batch = frame(spark, [(10, day("2024-01-15"), "x"), (11, day("2024-05-01"), "x")])
    t.refresh_slices(batch)
    assert keys(t) == [3, 4, 10, 11]
    t.refresh_slices(frame(spark, [(12, day("2024-01-16"), "x")]), [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 1)])
    assert keys(t) == [4, 11, 12]


def test_one_month_is_read_by_partition_pruning(spark, db):
    t = make(spark, db)
    plan = t.scan("2024-01-01", "2024-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d" in plan
