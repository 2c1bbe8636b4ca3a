"""Quoted text read in splits equals the reader that takes files whole."""

import random
import re

import pytest

from millrace.sources import quoted
from millrace.sources.files import read_delimited


def made(seed, n, sep="\n"):
    draw = random.Random(seed)
    pieces = ["a", "b c", "é", "|", "\n", "\r\n", '\\"', "\\\\", "x" * 50, "", "5", " "]

    def value():
        if draw.random() < 0.5:
            return draw.choice(["plain", "7", "", 'inch 5" pipe', "it's", "a b"])
        return '"' + "".join(draw.choice(pieces) for _ in range(draw.randint(0, 6))) + '"'

    return "id|t|u" + sep + sep.join(f"{i}|{value()}|{value()}" for i in range(n)) + sep


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("size", ["300b", "128m"])
@pytest.mark.parametrize("seed", range(2))
def test_splits_of_any_size(spark, tmp_path, seed, size):
    for i in range(2):
        (tmp_path / f"f{i}.csv").write_bytes(made(seed * 10 + i, 300).encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    expected = rows_of(read_delimited(spark, str(tmp_path), quote='"', all_text=True, multi_line=True, with_file_name=True))
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = read_delimited(spark, str(tmp_path), quote='"', all_text=True, with_file_name=True)
        assert rows_of(found) == expected and len(expected) == 600
        tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        assert size == "128m" or tasks > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_line_ends_and_types(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes(b'id|t|d\r\n1|"a\r\nb"|2024-01-01\r\n\r\n2||\r\n3|"|"|x\r\n')
    for options in ({"all_text": True}, {"infer_looks": True}, {}, {"schema": "id int, t string, d string"}):
        split, whole = (read_delimited(spark, str(tmp_path), quote='"', multi_line=m, **options) for m in (None, True))
        assert [(f.name, f.dataType) for f in split.schema] == [(f.name, f.dataType) for f in whole.schema] and rows_of(split) == rows_of(whole)
    plan = read_delimited(spark, str(tmp_path), quote='"', all_text=True)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" in plan and "Python" not in plan


STRAY = ['a|"x""y"\nb|c\n', 'a|"x"y\n"|c\n', '"a" |b\n1|2\n', 'a|"never closed\n1|2\n', 'a|"x"\r\n1|2\n']


@pytest.mark.parametrize("body", STRAY)
def test_stray_quotes_are_left_to_the_whole_reader(spark, tmp_path, body):
    (tmp_path / "w.csv").write_bytes(("s|t\n" + body).encode())
    found, whole = (read_delimited(spark, str(tmp_path), quote='"', all_text=True, multi_line=m) for m in (None, True))
    assert rows_of(found) == rows_of(whole)


def test_states_of_lines():
    pattern = lambda f, s: re.compile(f("|", '"', s).replace(r"\z", r"\Z"))
    cases = [
        ("a|b", "out", "in"), ('"a"|b', "out", None), ('a|"b', "in", None), ('5" x|y', "out", None), ('b"|c', "out", "out"),
        ('b"|c|"d', "in", "in"), ('""', "out", None), ('"a\\"', "in", None), ("", "out", "in"), ('"a""b', None, None), ('"a\\', "in", None),
    ]
    for line, *wanted in cases:
        for inside, want in zip((False, True), wanted, strict=True):
            found = "out" if pattern(quoted.closes, inside).match(line) else "in" if pattern(quoted.opens, inside).match(line) else None
            assert found == want, (line, inside)
    assert not quoted.splittable('a|"b', "|", '"') and quoted.splittable("a|b\r", "|", '"')
