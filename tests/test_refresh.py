"""Refresh algebra: what is hit, what stays, repeating a refresh."""

import datetime as dt
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.operators.refresh import Mode, RefreshSpec, parse_mode, refresh, resolve, upsert

DDL = "k int, d timestamp_ntz, FILE_NAME string"


def day(text):
    return dt.datetime.fromisoformat(text)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


TARGET = [
    (1, day("2024-02-29 23:59:59.500000"), "a"),
    (2, day("2024-03-01"), "a"),
    (3, day("2024-01-31 23:59:59.999999"), "b"),
    (4, day("2024-02-01"), "b"),
    (5, None, "c"),
    (6, day("2024-02-10"), None),
]


def kept(spark, spec, batch=()):
    out = refresh(frame(spark, TARGET), frame(spark, list(batch)), spec)
    return sorted(r["k"] for r in out.collect())


def test_month_is_whole_and_half_open(spark):
    spec = RefreshSpec(refresh_type="PARTITION_MTD", partition_column="d", partition_value="2024-02-15")
    assert kept(spark, spec) == [2, 3, 5]


def test_single_value(spark):
    spec = RefreshSpec(refresh_type="PARTITION", partition_column="d", partition_value="2024-02-01")
    assert kept(spark, spec) == [1, 2, 3, 5, 6]
    spec = RefreshSpec(refresh_type="PARTITION", partition_column="FILE_NAME", partition_value="a")
    assert kept(spark, spec) == [3, 4, 5, 6]


def test_batch_bounds_and_empty_batch(spark):
    spec = RefreshSpec(refresh_type="PARTITION_N_DAYS", partition_column="d")
    batch = [(10, day("2024-02-01 08:00"), "x"), (11, day("2024-02-10 01:00"), "x")]
    assert kept(spark, spec, batch) == [1, 2, 3, 5, 10, 11]
    assert kept(spark, spec) == [1, 2, 3, 4, 5, 6]


def test_window_of_days(spark):
    spec = RefreshSpec(
        refresh_type="PARTITION_N_DAYS", partition_column="d", partition_value="2024-02-10", n_days=9
    )
    assert kept(spark, spec) == [1, 2, 3, 5]


def test_files_from_batch_or_argument(spark):
    spec = RefreshSpec(ingest_type="CDC")
    assert kept(spark, spec, [(10, None, "a"), (11, None, None)]) == [3, 4, 5, 6, 10, 11]
    assert kept(spark, RefreshSpec(ingest_type="CDC", file_names="b")) == [1, 2, 5, 6]
    assert kept(spark, spec, [(11, None, None)]) == [1, 2, 3, 4, 5, 6, 11]


def test_files_without_a_file_column_append(spark):
    target, batch = frame(spark, TARGET).drop("FILE_NAME"), frame(spark, TARGET)
    assert resolve(RefreshSpec(ingest_type="CDC"), batch, target.columns).empty


def test_full_takes_batch_schema(spark):
    batch = spark.createDataFrame([(1, "n")], "k int, fresh string")
    assert refresh(frame(spark, TARGET), batch, RefreshSpec(refresh_type="FULL")).columns == ["k", "fresh"]


@pytest.mark.parametrize("spec", [RefreshSpec(), RefreshSpec(ingest_type="SNAPSHOT"), RefreshSpec(ingest_type="INCREMENTAL")])
def test_nothing_deleted(spark, spec):
    assert kept(spark, spec, [(7, None, "a")]) == [1, 2, 3, 4, 5, 6, 7]


def test_dispatch():
    assert parse_mode("partition_mtd") is Mode.PARTITION_MTD
    assert RefreshSpec(refresh_type="FULL", ingest_type="CDC").mode is Mode.FULL
    assert RefreshSpec(ingest_type="CDC").mode is Mode.CDC
    with pytest.raises(ValueError):
        parse_mode("NO_SUCH_MODE")
    with pytest.raises(ValueError):
        RefreshSpec(refresh_type="CDC").mode  # noqa: B018
    with pytest.raises(ValueError, match="partition_column"):
        RefreshSpec(refresh_type="PARTITION_MTD").column  # noqa: B018


SPECS = [
    RefreshSpec(refresh_type="PARTITION_MTD", partition_column="d", partition_value="2024-02-15"),
    RefreshSpec(refresh_type="PARTITION_N_DAYS", partition_column="d"),
    RefreshSpec(ingest_type="CDC"),
    RefreshSpec(refresh_type="FULL"),
]
moments = st.one_of(st.none(), st.datetimes(day("2024-01-28"), day("2024-03-04")))
rows = st.lists(st.tuples(st.integers(0, 9), moments, st.sampled_from(["a", "b", None])), max_size=8)


@settings(max_examples=6, deadline=None)
@given(rows, rows, st.sampled_from(SPECS))
def test_repeating_changes_nothing_and_other_rows_stay(spark, target, batch, spec):
    if spec.mode is Mode.PARTITION_MTD:
        batch = [b for b in batch if b[1] and b[1].year == 2024 and b[1].month == 2]
    elif spec.mode is Mode.PARTITION_N_DAYS:
        batch = [b for b in batch if b[1]]
    elif spec.mode is Mode.CDC:
        batch = [b for b in batch if b[2]]
    t, b = frame(spark, target), frame(spark, batch)
    once = bag(refresh(t, b, spec))
    assert bag(refresh(frame(spark, list(once.elements())), b, spec)) == once
    assert not bag(b) - once
    if spec.mode is not Mode.FULL:
        nulls = Counter(r for r in target if (r[2] if spec.mode is Mode.CDC else r[1]) is None)
        assert not nulls - once


def test_upsert_last_record_wins(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    records = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k int, v string, n int")
    assert bag(upsert(target, records, ["k"], ["n"])) == Counter([(1, "old"), (2, "y"), (3, "z")])
