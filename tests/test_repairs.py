"""What must not be lost: late values, mixed folders, crashes between steps, repeated keys."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.context import RunContext
from millrace.operators import changes, lineage
from millrace.operators.calendar import slice_start
from millrace.operators.refresh import RefreshSpec, upsert
from millrace.operators.relational import money_sum
from millrace.plans import jobs
from millrace.plans.table import SLICE, WarehouseTable, ensure_database
from millrace.session import scratch_dir
from millrace.sources import files, listing, streams, workbook

CTX = RunContext("2024-01-20", "job", dt.datetime(2024, 2, 1))


@pytest.fixture
def db(spark):
    name = f"r_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, name, scratch_dir(spark, name))
    return name


def put(folder, name, data):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_late_misfit_keeps_the_column_text(spark, tmp_path):
    path = put(tmp_path, "a.csv", "n|t\n" + "1|x\n" * 60_000 + "late|x\n")
    out = files.read_delimited(spark, path, infer_looks=True)
    assert dict(out.dtypes)["n"] == "string"
    assert out.where("n = 'late'").count() == 1 and out.where("n IS NULL").count() == 0


@pytest.mark.parametrize("suffix", ["", "/*.csv"])
def test_columns_of_a_folder_go_by_name(spark, tmp_path, suffix):
    put(tmp_path, "a.csv", "id|name\n1|a\n")
    put(tmp_path, "b.csv", "name|id\nb|2\n")
    put(tmp_path, "c.csv", "id,name\n3,c\n")
    out = files.read_files(spark, f"{tmp_path}{suffix}", "csv", auto_delimiter=True)
    assert rows(out.select("id", "name")) == [(1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(ValueError, match="by position"):
        files.read_delimited(spark, str(tmp_path), schema="id int, name string")


def test_one_late_byte_decides_the_encoding(spark, tmp_path):
    late = b"t\n" + b"x\n" * 100_000 + "é\n".encode("latin-1")
    path = put(tmp_path, "a.csv", late)
    assert files.read_files(spark, path, "csv", encoding="auto").where("t = 'é'").count() == 1
    found = listing.detect_encoding(spark, str(tmp_path))
    assert [r.encoding for r in found.collect()] == ["ISO-8859-1"]


@pytest.mark.parametrize(
    ("path", "expected"),
    [("s3a://b/k", "s3://b/k"), ("file:/t/x", "file:///t/x"), ("file:///t", "file:///t"), ("/t/x", "/t/x"), ("gs://b/k", "gs://b/k")],
)
def test_schemes_of_stores(path, expected):
    assert streams.stream_uri(path) == expected


def test_small_amounts_are_summed_whole(spark):
    df = spark.createDataFrame([(0.00004,)] * 10 + [(12345678.25,)], "x double")
    assert df.agg(money_sum(F.col("x"))).first()[0] == 12345678.2504


@pytest.mark.parametrize("amount", [4e-9, 1.000000004, 0.123456789])
def test_amounts_finer_than_the_unit_fail(spark, amount):
    df = spark.createDataFrame([(amount,)] * 10 + [(None,), (1e7 * 0.07 * 1.1,)], "x double")
    with pytest.raises(PySparkException, match="more than 8 decimals"):
        df.agg(money_sum(F.col("x"))).collect()
    assert abs(df.agg(money_sum(F.col("x"), 9)).first()[0] - (10 * amount + 1e7 * 0.07 * 1.1)) < 1e-6


def test_a_header_far_down_is_found(spark):
    rows_ = [("s", i, ["a", "a"] if i != 60 else ["id", "name", "day"]) for i in range(1, 100)]
    found = workbook.header_row(spark.createDataFrame(rows_, "sheet string, row_index int, cells array<string>"), ["sheet"])
    assert found.first()["header_row"] == 60


def test_long_texts_fail_where_a_limit_is_set(spark, db):
    table = WarehouseTable(spark, f"{db}.t", text_limit=3)
    table.append(spark.createDataFrame([("abc",), (None,)], "v string"))
    with pytest.raises(PySparkException, match="longer than 3"):
        WarehouseTable(spark, f"{db}.t").append(spark.createDataFrame([("abcd",)], "v string"))
    assert table.read().count() == 2


def test_unknown_slice_intervals_are_errors(spark, db):
    for name in ("HOURLY", "monthly"):
        with pytest.raises(ValueError, match="slice interval"):
            WarehouseTable(spark, f"{db}.t", "d", name)
        with pytest.raises(ValueError, match="slice interval"):
            slice_start("d", name)


def months(spark, n=3, name="a"):
    return spark.createDataFrame([(i, dt.datetime(2024, 1 + i % n, 5), name) for i in range(30)], "k int, d timestamp_ntz, FILE_NAME string")


class Crash(Exception):
    pass


def dying(table, step):
    """Let the table's next run die after the given number of changes to the catalog."""
    left, run = [step], table._run

    def counted(statement):
        if not left[0]:
            raise Crash
        left[0] -= 1
        run(statement)

    table._run = counted
    return table


def tables(spark, db):
    return sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect() if not r.isTemporary)


FULL_CHANGES = 3  # a version made, the view switched, the old version dropped


@pytest.mark.parametrize("column", ["d", None])
@pytest.mark.parametrize("second", range(FULL_CHANGES + 1))
@pytest.mark.parametrize("first", range(FULL_CHANGES + 1))
def test_full_refreshes_that_die_twice_never_lose_or_age_a_row(spark, db, first, second, column):
    states = [rows(months(spark, name=n)) for n in "abc"]
    WarehouseTable(spark, f"{db}.t", column).append(months(spark, name="a"))
    seen = 0
    for step, (name, state) in zip((first, second), (("b", 1), ("c", 2)), strict=True):
        writer = dying(WarehouseTable(spark, f"{db}.t", column), step)
        try:
            writer.replace(months(spark, name=name))
            done = True
        except Crash:
            done = False
        found = states.index(rows(WarehouseTable(spark, f"{db}.t").read()))
        assert found in (seen, state) and (found == state or not done)
        seen = found
    table = WarehouseTable(spark, f"{db}.t")
    assert table.partition_column == column
    table.replace(months(spark, name="a"))
    assert rows(spark.table(f"{db}.t").drop(SLICE)) == states[0]
    assert tables(spark, db) == ["t"] and len(tables(spark, f"{db}__versions")) == 1


@pytest.mark.parametrize("step", range(5))
def test_swaps_that_die_leave_the_table(spark, db, step):
    old, new = WarehouseTable(spark, f"{db}.t"), WarehouseTable(spark, f"{db}.n", "d")
    old.append(months(spark))
    new.append(months(spark))
    try:
        dying(old, step).swap_with(new, content=True)
    except Crash:
        pass
    again = WarehouseTable(spark, f"{db}.t")
    assert rows(again.read()) == rows(months(spark))
    assert again.repartition("d") and again.slices()
    assert rows(WarehouseTable(spark, f"{db}.t").read()) == rows(months(spark))


def test_readers_change_nothing(spark, db):
    table = WarehouseTable(spark, f"{db}.t")
    table.append(months(spark))
    left = table._location(table._create_version(table.schema))
    spark.range(3).createOrReplaceTempView(f"t__v{99}")
    try:
        assert rows(WarehouseTable(spark, f"{db}.t").read()) == rows(months(spark))
        assert len(tables(spark, f"{db}__versions")) == 2 and table._versions() == [1, 2]
        open_reader = table.read()
        table.replace(months(spark, name="b"))
        assert table._location() != left and len(tables(spark, f"{db}__versions")) == 1
    finally:
        spark.catalog.dropTempView("t__v99")
    assert open_reader.columns == ["k", "d", "FILE_NAME"]
    spark.sql(f"CREATE TABLE {db}.plain (k int) USING parquet")
    with pytest.raises(ValueError, match="not a table made"):
        WarehouseTable(spark, f"{db}.plain")


def test_view_shows_new_columns(spark, db):
    table = WarehouseTable(spark, f"{db}.t", "d")
    table.append(months(spark))
    dying(table, 1)
    with pytest.raises(Crash):
        table.add_columns([T.StructField("more", T.IntegerType())])
    again = WarehouseTable(spark, f"{db}.t")
    again.add_columns([])
    assert "more" in spark.table(f"{db}.t").columns


def files_of(spark, table):
    found = spark.table(table.stored).select(SLICE, F.col("_metadata.file_path").alias("f")).distinct().collect()
    out = {}
    for r in found:
        out.setdefault(r[SLICE], set()).add(r.f)
    return out


def test_slices_without_hits_keep_their_files(spark, db):
    table = WarehouseTable(spark, f"{db}.t", "d")
    table.append(months(spark))
    before = files_of(spark, table)
    new = months(spark, name="b")
    for _ in range(2):
        table.refresh(new, RefreshSpec(ingest_type="CDC"))
        assert rows(table.read()) == rows(months(spark).union(new))
    after = files_of(spark, table)
    fresh = WarehouseTable(spark, f"{db}.u", "d")
    fresh.append(months(spark))
    kept = files_of(spark, fresh)
    fresh.refresh(new, RefreshSpec(ingest_type="CDC"))
    assert all(kept[s] < files_of(spark, fresh)[s] for s in kept)
    fresh.upsert(spark.createDataFrame([(3, dt.datetime(2024, 1, 5), "z"), (99, dt.datetime(2024, 2, 5), "z")], table.schema), ["k"])
    assert fresh.read().where("FILE_NAME = 'z'").count() == 2
    assert set(before) == set(after)


def test_differing_records_of_one_key_need_an_order(spark, db):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    two = spark.createDataFrame([(1, "b"), (1, "c"), (2, "d"), (2, "d")], "k int, v string")
    with pytest.raises(PySparkException, match="no order"):
        upsert(target, two, ["k"]).collect()
    assert rows(upsert(target, two.where("k = 2"), ["k"])) == [(1, "a"), (2, "d")]
    assert rows(upsert(target, two, ["k"], ["v"])) == [(1, "c"), (2, "d")]


def test_null_keys_do_not_multiply(spark):
    old = spark.createDataFrame([(None, "a"), (None, "a"), (None, "b"), (1, "x")], "k int, v string")
    new = spark.createDataFrame([(None, "a"), (None, "c"), (2, "y")], "k int, v string")
    assert rows(changes.scd2_delta(old, new, ["k"], ["v"])) == [(1, None, "expire"), (2, "y", "insert"), (None, "c", "update")]
    plan = changes.scd2_delta(old, new, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_lineage_of_any_depth(spark):
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(40)], "node_id string, child_node_id string")
    start = spark.createDataFrame([("n0",)], "node string")
    found = lineage.reachable(chain, start)
    assert found.count() == 40


def test_lineage_takes_rounds_by_the_logarithm_of_the_depth(spark, monkeypatch):
    labels = []
    plain = lineage.stage
    monkeypatch.setattr(lineage, "stage", lambda df, label: labels.append(label) or plain(df, label))
    chain = spark.createDataFrame([(i, i + 1) for i in range(150)], "node_id long, child_node_id long")
    start = spark.createDataFrame([(0,), (100,), (100,)], "node long")
    found = rows(lineage.reachable(chain, start))
    assert found == sorted([(0, i) for i in range(1, 151)] + [(100, i) for i in range(101, 151)], key=str)
    assert labels.count("jumps") <= 9


def test_lineage_of_graphs_with_cycles(spark):
    rng = random.Random(5)
    for n, m in ((6, 5), (12, 14), (20, 60)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(1, 1), (2, 3), (3, 4), (4, 2), (None, 3)]
        expected = set()
        for start in range(n):
            seen, todo = set(), [start]
            while todo:
                node = todo.pop()
                fresh = {b for a, b in links if a == node} - seen
                seen |= fresh
                todo.extend(fresh)
            expected |= {(start, node) for node in seen}
        edges = spark.createDataFrame(links, "node_id int, child_node_id int")
        starts = spark.createDataFrame([(i,) for i in range(n)], "node int")
        assert rows(lineage.reachable(edges, starts)) == sorted(expected, key=str)
    nothing = edges.where("false")
    assert rows(lineage.reachable(nothing, starts)) == []


def test_lines_of_files_with_one_name_are_counted_apart(spark, db, tmp_path):
    put(tmp_path, "x/o.csv", "id\n1\n2\n")
    put(tmp_path, "y/o.csv", "id\n3\n4\n5\n")
    found = listing.list_directory(spark, str(tmp_path), "*.csv", recursive=True)
    table = WarehouseTable(spark, f"{db}.t")
    out = jobs.logged_files_job(spark, found, found.where("false"), table, CTX, "csv")
    assert sorted((r.parent_path[-1], r.n_lines) for r in out.collect()) == [("x", 2), ("y", 3)]


def test_month_refresh_logs_superseded_files(spark, db, tmp_path):
    for name, value in (("s_1.csv", 1), ("s_2.csv", 2)):
        put(tmp_path, name, f"v|d\n{value}|2024-01-05 00:00:00\n")
    table, log = WarehouseTable(spark, f"{db}.t", "D"), WarehouseTable(spark, f"{db}.log")
    read = {"schema": "v int, d timestamp_ntz"}

    def run():
        found = listing.list_directory(spark, str(tmp_path), "*.csv")
        return jobs.incremental_files_job(spark, found, log, table, CTX, "csv", None, "MTD", "2024-01", read_options=read)

    assert [p[-7:] for p in run()] == ["s_2.csv"] and run() == []
    assert [r.V for r in table.read().collect()] == [2]
