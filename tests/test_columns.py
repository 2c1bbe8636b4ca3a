"""Column functions: documented examples, edge cases, and agreement with plain Python."""

import base64
import datetime as dt
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions import dates, naming, text


def values(spark, rows, column, ddl="x string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in rows], ddl).select(column).collect()]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("1_column>name", "C_1_COLUMNGT_NAME"),
        ("Column 1", "COLUMN_1"),
        ("Value Column", "VALUE_COLUMN"),
        ("điểm số", "DIEM_SO"),
        ("a>=b", "AGT_B"),
        ("_1x", "1X"),
        ("__x", "_X"),
        ("x__", "X_"),
        ("Đơn giá (VNĐ)", "DON_GIA_VND"),
    ],
)
def test_name_examples(spark, name, expected):
    assert naming.normalize_name(name) == expected
    assert values(spark, [name], naming.normalize_values("x")) == [expected]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aZ0_9 ><=-éđỪß.#²½", max_size=12), min_size=30, max_size=60))
def test_names_and_values_agree(spark, names):
    assert values(spark, names, naming.normalize_values("x")) == [naming.normalize_name(n) for n in names]


def test_equal_names_are_an_error(spark):
    with pytest.raises(ValueError, match="equal after normalising"):
        naming.normalize_columns(spark.createDataFrame([(1, 2)], ["a b", "a-b"]))


def test_fold_accents(spark):
    assert values(spark, ["điểm số", None], naming.fold_accents("x")) == ["diem so", None]


@pytest.mark.parametrize(
    "pattern, expected",
    [
        ("%Y-%m-%d", "yyyy-M-d"),
        ("%Y%m%d", "yyyyMMdd"),
        ("M%m.%Y", "'M'M.yyyy"),
        ("%d/%m/%y %H:%M:%S", "d/M/yy H:m:s"),
    ],
)
def test_spark_pattern(pattern, expected):
    assert dates.spark_pattern(pattern) == expected


def test_parse_date(spark):
    rows = ["2025-01-01", "45292", "45292.7", "0", "", None, "2024-2-9", "1e3"]
    day = dt.datetime
    expected = [
        day(2025, 1, 1), day(2024, 1, 1), day(2024, 1, 1), day(1899, 12, 30), None, None, day(2024, 2, 9),
        day(1902, 9, 26),
    ]
    assert values(spark, rows, dates.parse_date("x", "%Y-%m-%d")) == expected


def test_parse_date_compact_digits_follow_the_pattern(spark):
    assert values(spark, ["20200131"], dates.parse_date("x", "%Y%m%d")) == [dt.datetime(2020, 1, 31)]


@pytest.mark.parametrize("bad", ["bad", "nan", "2024-13-01"])
def test_parse_date_strict_fails(spark, bad):
    with pytest.raises(PySparkException, match="does not match"):
        values(spark, [bad], dates.parse_date("x", "%Y-%m-%d"))
    assert values(spark, [bad], dates.parse_date("x", "%Y-%m-%d", strict=False)) == [None]


def test_parse_dates_integer_zero_is_null(spark):
    df = spark.createDataFrame([(0, 1.0), (45292, 2.0)], "n int, d double")
    out = dates.parse_dates(df, ["n", "d"], "%Y").collect()
    assert [tuple(r) for r in out] == [(None, 1.0), (dt.datetime(2024, 1, 1), 2.0)]


def test_month_labels(spark):
    rows = ["M12.2023", "M1.2024", None]
    expected = [dt.datetime(2023, 12, 1), dt.datetime(2024, 1, 1), None]
    assert values(spark, rows, dates.parse_month_label("x")) == expected
    assert values(spark, ["M12/2023", "M1-2024", None], dates.text_month("x")) == expected
    assert values(spark, ["M1\\2024", "bad", ""], dates.text_month("x")) == [dt.datetime(2024, 1, 1), None, None]


def test_date_columns(spark):
    df = spark.createDataFrame(
        [], "a date, b timestamp, load_dt int, dttm_x int, my_dttm_x int, update int, order_dt bigint, s string"
    )
    assert dates.date_columns(df.schema) == ["a", "b", "load_dt", "my_dttm_x", "update"]


def test_serial_dates(spark):
    df = spark.createDataFrame([(45292, dt.datetime(2024, 5, 1, 12))], "x_dt int, t timestamp_ntz")
    assert tuple(dates.standardize_dates(df).first()) == (dt.date(2024, 1, 1), dt.date(2024, 5, 1))


def test_zone_labels(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1),), (None,)], "t timestamp_ntz")
    labels = [tuple(r) for r in df.select(
        dates.format_in_zone("t"),
        dates.format_in_zone("t", "UTC", "Asia/Kolkata"),
        dates.format_in_zone("t", "UTC", "America/New_York"),
    ).collect()]
    assert labels == [
        ("2024-07-01 07:00:00 +07", "2024-07-01 05:30:00 +0530", "2024-06-30 20:00:00 -04"),
        ("", "", ""),
    ]


@pytest.mark.parametrize(
    "size, expected",
    [
        (0, "0.00 B"), (1023, "1023.00 B"), (1024, "1.00 KiB"), (1048576, "1.00 MiB"), (123456789, "117.74 MiB"),
        (1024**4, "1.00 TiB"), (1024**6 * 3, "3072.00 PiB"),
    ],
)
def test_human_size(spark, size, expected):
    assert values(spark, [float(size)], text.human_size("x"), "x double") == [expected]


def test_human_size_ties_round_to_even(spark):
    sizes = [float(n) for n in range(0, 40000, 7)]
    expected = [f"{n:.2f} B" if n < 1024 else f"{n / 1024:.2f} KiB" for n in sizes]
    assert values(spark, sizes, text.human_size("x"), "x double") == expected


def test_path_parts(spark):
    df = spark.createDataFrame([("/a/b/c.tar.GZ",), ("c",), ("/a/.hidden",)], "p string")
    out = df.select(text.base_name("p"), text.parent_path("p"), text.suffix("p"), text.stem("p")).collect()
    assert [tuple(r) for r in out] == [
        ("c.tar.GZ", "/a/b", "gz", "c.tar"),
        ("c", ".", "", "c"),
        (".hidden", "/a", "", ".hidden"),
    ]


def test_hash_and_base64_agree_with_python(spark):
    words = ["", "điểm", "x" * 500]
    expected = [hashlib.blake2b(w.encode()).hexdigest() for w in words]
    assert values(spark, words, text.blake2b_hex(F.encode("x", "UTF-8"))) == expected
    encoded = [base64.b64encode(w.encode()).decode() for w in words]
    assert values(spark, words, text.base64_encode("x")) == encoded
    assert values(spark, encoded, text.base64_decode("x")) == words


def test_name_filter_null_is_no_match(spark):
    assert values(spark, ["a.csv", None, "acsv"], text.name_matches("x", ".csv")) == [True, False, False]
    assert values(spark, ["a1.csv", "b.csv"], text.name_matches("x", "^a[0-9]")) == [True, False]


def test_duration_counts_second_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 0, 0, 1, 100000))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(dates.duration_seconds("a", "b")).first()[0] == 1


def test_epoch_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Bangkok")
    try:
        assert values(spark, [0], dates.epoch_seconds("x"), "x bigint") == [dt.datetime(1970, 1, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
