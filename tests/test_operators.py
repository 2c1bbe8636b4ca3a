"""Schema, changes, calendar and lineage on constructed cases."""

import datetime as dt

import pytest
from dateutil.relativedelta import relativedelta
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import calendar as K
from millrace.operators import changes as C
from millrace.operators import lineage
from millrace.operators import schema as S
from millrace.operators.relational import group_bounds, union_by_name
from millrace.operators.reconcile import content_mismatch, month_mismatch, reconcile_totals, row_differences


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# schema


def test_sink_types(spark):
    cases = {
        "tinyint": "int", "int": "int", "bigint": "bigint", "float": "float", "double": "decimal(30,8)",
        "decimal(5,2)": "decimal(30,8)", "string": "string", "date": "timestamp_ntz", "timestamp": "timestamp_ntz",
        "boolean": "boolean",
    }
    for given_type, expected in cases.items():
        assert S.sink_type(T._parse_datatype_string(given_type)).simpleString() == expected


def test_reconcile_order(spark):
    sink = T.StructType.fromDDL("id bigint, name string, gone int")
    df = spark.createDataFrame([("1", "a", 9)], "id string, name string, extra int")
    out = S.reconcile(df, sink, lambda d: d.withColumn("audit", F.lit("x")))
    assert out.columns == ["id", "name", "gone", "audit"]
    assert tuples(out) == [(1, "a", None, "x")]


def test_strict_cast_fails_and_lenient_gives_null(spark):
    sink = T.StructType.fromDDL("id bigint")
    df = spark.createDataFrame([("1",), ("x",), (None,)], "id string")
    with pytest.raises(PySparkException):
        S.sync_types(df, sink).collect()
    assert tuples(S.sync_types(df, sink, strict=False)) == [(1,), (None,), (None,)]
    assert tuples(S.cast_losses(df, sink)) == [("id", 1)]


def test_transform_that_drops_a_sink_column_fails(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="missing in the batch"):
        S.reconcile(df, df.schema, lambda d: d.drop("b"))


def test_required_columns(spark):
    sink = T.StructType.fromDDL("a int not null, b int")
    ok = spark.createDataFrame([(1, None)], "a int, b int")
    assert tuples(S.reconcile(ok, sink)) == [(1, None)]
    with pytest.raises(PySparkException, match="NULL in column a"):
        S.reconcile(spark.createDataFrame([(None, 1)], "a int, b int"), sink).collect()


def test_text_width(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2)], "t string, n int")
    assert tuples(S.require_width(df, 2)) == [("ab", 1), (None, 2)]
    with pytest.raises(PySparkException, match="longer than 1 in column t"):
        S.require_width(df, 1).collect()
    assert tuples(S.width_profile(df, 1)) == [("t", 2, True)]


def test_union_aligns_types(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([("u", 2.5)], "x string, y double")
    assert tuples(union_by_name([a, b])) == [("1", 2.0), ("u", 2.5)]


# changes

FILES = "parent_path string, filename string, last_modified_dt timestamp_ntz, st_size bigint"
T1, T2 = dt.datetime(2024, 1, 1, 8, 0, 0, 250000), dt.datetime(2024, 1, 2)


def names(df):
    return sorted(r["filename"] for r in df.collect())


def test_new_files_cases(spark):
    listing = spark.createDataFrame(
        [("p", "a1.csv", T1, 5), ("p", "a2.csv", T2, 5), ("p", "a3.csv", T2, None), ("p", "b.txt", T1, 5)], FILES
    )
    log = spark.createDataFrame([("p", "a1.csv", T1.replace(microsecond=0), 5), ("p", "a2.csv", T1, 5)], FILES)
    sink = spark.createDataFrame([("a2.csv",)], "filename string")
    nothing = log.where("false")
    assert names(C.new_files(listing, log, pattern="^a[0-9]")) == ["a2.csv"]
    assert names(C.new_files(listing, log, sink, pattern=".csv")) == []
    assert names(C.new_files(listing, log, sink, pattern=".csv", reload_modified=True)) == ["a2.csv"]
    assert names(C.new_files(listing, log, pattern="a1", force_rerun=True)) == ["a1.csv"]
    assert names(C.new_files(listing.where("false"), log)) == []
    assert names(C.new_files(listing, nothing)) == ["a1.csv", "a2.csv", "a3.csv", "b.txt"]


def test_masterdata_cases(spark):
    listing = spark.createDataFrame([("p", f"m{i}", T1, 5) for i in (1, 2, 3)], FILES)
    nothing = listing.where("false")
    sink = spark.createDataFrame([("m1",), ("m3",)], "filename string")
    assert names(C.new_files(listing, nothing, masterdata=True)) == ["m3"]
    assert names(C.new_files(listing, nothing, sink.where("filename = 'm1'"), masterdata=True)) == ["m3"]
    assert names(C.new_files(listing, nothing, sink, masterdata=True)) == []
    assert names(C.new_files(listing, nothing, sink.where("false"), masterdata=True)) == ["m3"]


def test_changed_content_cases(spark):
    now = spark.createDataFrame([("same", "h1"), ("moved", "h2"), ("new", "h3")], "file_name string, hash_check_sum string")
    log = spark.createDataFrame(
        [("same", "h0", 1), ("same", "h1", 2), ("moved", "h2", 1), ("moved", "h9", 2)],
        "file_name string, hash_check_sum string, st_mtime int",
    )
    out = {r["file_name"]: r["is_changed"] for r in C.changed_content(now, log).collect()}
    assert out == {"same": False, "moved": True, "new": True}


SCD = "k int, a string, b int"


def test_scd2_null_rules(spark):
    old = spark.createDataFrame([(1, None, 1), (2, "x", 1), (3, None, None), (4, "x", 1), (5, "x", 1)], SCD)
    new = spark.createDataFrame([(1, "y", 1), (2, None, 1), (3, None, None), (4, "z", 2), (6, "x", 1)], SCD)
    delta = tuples(C.scd2_delta(old, new, ["k"], ["a", "b"]))
    assert delta == [
        (1, "y", 1, "update"), (2, None, 1, "update"), (4, "z", 2, "update"), (5, None, None, "expire"),
        (6, "x", 1, "insert"),
    ]


keyed = st.dictionaries(st.integers(0, 6), st.sampled_from(["x", "y", None]), max_size=6)


@settings(max_examples=5, deadline=None)
@given(keyed, keyed)
def test_scd2_every_key_has_one_open_version(spark, old, new):
    first = C.scd2_start(spark.createDataFrame(list(old.items()), "k int, a string"), "2024-01-01")
    after = C.scd2_dimension(first, spark.createDataFrame(list(new.items()), "k int, a string"), ["k"], ["a"], "2024-02-01")
    again = C.scd2_dimension(after, spark.createDataFrame(list(new.items()), "k int, a string"), ["k"], ["a"], "2024-03-01")
    open_rows = {(r["k"], r["a"]) for r in after.where("is_current").collect()}
    assert open_rows == set(new.items())
    assert {r["k"] for r in after.where("NOT is_current").collect()} == {k for k in old if old[k] != new.get(k, "-")}
    assert tuples(again) == tuples(after)


def test_retention_with_a_hot_key_and_short_groups(spark):
    rows = [("hot", i) for i in range(2000)] + [("one", 1), ("two", 1), ("two", 2), (None, 1), (None, 2), (None, 3)]
    df = spark.createDataFrame(rows, "k string, n int")
    expired = C.retention_expired(df, ["k"], ["n"], 2)
    assert tuples(expired) == sorted([("hot", i) for i in range(1998)] + [(None, 1)], key=repr)


def test_group_bounds_null_group(spark):
    df = spark.createDataFrame([(None, 1), ("a", 1), ("a", 3)], "k string, n int")
    assert tuples(group_bounds(df, ["k"], "n", "n")) == [("a", 1, 1, 3), ("a", 3, 1, 3), (None, 1, None, None)]


def test_content_differences(spark):
    kind = "k int, a string, b string"
    old = spark.createDataFrame([(1, "x", None), (1, "y", "y"), (1, "y", "y"), (2, "z", "z"), (None, None, None)], kind)
    new = spark.createDataFrame([(1, None, "x"), (1, "y", "y"), (2, "z", "z"), (2, "z", "z"), (None, None, None)], kind)
    same = spark.createDataFrame([(r.b, r.k, r.a) for r in old.collect()[::-1]], "b string, k int, a string")
    assert tuples(content_mismatch(old, new, F.col("k"))) == [(1, 3, 2), (2, 1, 2)]
    for parts in (1, 4096):
        assert tuples(row_differences(old, same, parts)) == []
        found = row_differences(old, new, parts).select("a", "old_rows", "new_rows").collect()
        assert sorted(found, key=str) == sorted([("x", 1, 0), (None, 0, 1), ("y", 2, 1), ("z", 1, 2)], key=str)
    # A value that moves to the next column of a row with NULLs is another row.
    assert not reconcile_totals(old.limit(1), old.limit(1).selectExpr("k", "b AS a", "a AS b"), content=True).first()["is_equal"]
    empty = old.where("false")
    assert row_differences(old, empty).agg(F.sum("old_rows")).first()[0] == 5
    assert tuples(content_mismatch(empty, empty, F.col("k"))) == []


def test_reconcile(spark):
    a = spark.createDataFrame([(1, dt.datetime(2024, 1, 5)), (2, None)], "k int, d timestamp_ntz")
    b = a.withColumn("k", F.col("k") + 1)
    assert reconcile_totals(a, b).first()["is_equal"]
    assert not reconcile_totals(a, b, content=True).first()["is_equal"]
    assert reconcile_totals(a, a.select("d", "k"), content=True).first()["is_equal"]
    assert month_mismatch(a.where("k = 2"), a, "d").count() == 0
    assert month_mismatch(a.where("k = 2"), a, "d", both_sides=True).count() == 1


# calendar


def plain_spine(start, end, unit, interval):
    """The stepping rule by date arithmetic on one thread."""
    step = relativedelta(**{unit: interval if start <= end else -interval})
    moment, out = start + relativedelta(days=1), []
    while (moment - relativedelta(days=1) <= end) if start <= end else (moment - relativedelta(days=1) >= end):
        out.append(moment - relativedelta(days=1))
        moment += step
    return out


spans = st.tuples(st.dates(dt.date(2015, 1, 1), dt.date(2026, 1, 1)), st.integers(-900, 900), st.sampled_from(["days", "weeks", "months", "years"]), st.integers(1, 3))


@settings(max_examples=4, deadline=None)
@given(st.lists(spans, min_size=20, max_size=40))
def test_spines_follow_the_stepping_rule(spark, cases):
    for unit in ("days", "weeks", "months", "years"):
        for interval in (1, 2, 3):
            chosen = [(s, s + dt.timedelta(days=n)) for s, n, u, i in cases if u == unit and i == interval]
            if not chosen:
                continue
            df = spark.createDataFrame(chosen, "s date, e date")
            got = [r[0] for r in df.select(K.date_spine("s", "e", unit, interval)).collect()]
            assert got == [plain_spine(s, e, unit, interval) for s, e in chosen]


def test_month_end_spine(spark):
    params = {"run_dates": {"start_date": "2024-01-31", "end_date": "2024-04-30", "mode": "monthly"}}
    out = [r[0] for r in K.resolve_run_dates(spark, params).collect()]
    assert out == ["2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30"]


def test_run_date_parameters(spark):
    def dates(params=None, logical=None):
        return [r[0] for r in K.resolve_run_dates(spark, params, logical).collect()]

    assert dates({"RUN_DATES": ["2024-01-01", "2024-01-05"]}) == ["2024-01-01", "2024-01-05"]
    assert dates({"run_dates": "2024-01-01"}) == ["2024-01-01"]
    assert dates(logical=dt.date(2024, 3, 1)) == ["2024-03-01"]
    same = {"run_dates": {"start_date": "2024-01-30", "end_date": "2024-01-30"}}
    assert dates(same) == ["2024-01-30"]
    down = {"run_dates": {"start_date": "2024-01-03", "end_date": "2024-01-01", "mode": "daily"}}
    assert dates(down) == ["2024-01-03", "2024-01-02", "2024-01-01"]
    with pytest.raises(ValueError, match="end_date"):
        dates({"run_dates": {"start_date": "2024-01-01"}})


def test_default_boundaries(spark):
    out = spark.range(1).select(K.partition_boundaries()).first()[0]
    assert (len(out), out[0], out[-1]) == (432, dt.date(2015, 1, 1), dt.date(2050, 12, 1))
    ints = spark.range(1).select(K.partition_boundaries(0, 10, 5)).first()[0]
    assert ints == [0, 5, 10]


def test_partition_number_edges(spark):
    days = [None, dt.datetime(2014, 12, 31, 23, 59, 59), dt.datetime(2015, 1, 1), dt.datetime(2015, 1, 31), dt.datetime(2015, 2, 1), dt.datetime(2060, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d timestamp_ntz")
    assert [r[0] for r in df.select(K.partition_number("d")).collect()] == [1, 1, 2, 2, 3, 433]


def test_slices_agree_with_the_driver_side(spark):
    days = [dt.datetime(2013, 3, 7, 5) + dt.timedelta(days=11 * i, hours=i) for i in range(300)]
    df = spark.createDataFrame([(d,) for d in days], "d timestamp_ntz")
    for interval in K.INTERVALS:
        got = [r[0] for r in df.select(K.slice_start("d", interval)).collect()]
        assert got == [K.slice_start_of(d, interval) for d in days]


def test_dated_paths(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 2)), (dt.date(2024, 2, 2), dt.date(2024, 1, 1))], "s date, e date")
    assert [r[0] for r in df.select(K.dated_paths("/p/", "s", "e")).collect()] == [
        "/p/2024/01/31/,/p/2024/02/01/,/p/2024/02/02/", "",
    ]
    assert df.select(K.dated_paths("/p", "s", "e", "months")).first()[0] == "/p/2024/01/31/"


# lineage


def test_lineage_ends_on_cycles(spark):
    edges = spark.createDataFrame([("m", "v"), ("v", "t"), ("t", "v"), ("v", "u")], "node_id string, child_node_id string")
    start = spark.createDataFrame([("m",)], "node string")
    assert tuples(lineage.reachable(edges, start)) == [("m", "t"), ("m", "u"), ("m", "v")]
    assert tuples(lineage.impact(edges, spark.createDataFrame([("u",)], "node string"))) == [("u", "m"), ("u", "t"), ("u", "v")]
    assert tuples(lineage.reachable(edges, spark.createDataFrame([("u",)], "node string"))) == []
