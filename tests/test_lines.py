"""Encodings and digests of files read in small splits, against plain Python."""

import codecs
import hashlib

import pytest

from millrace.sources import files, listing

SPLIT = "spark.sql.files.maxPartitionBytes"
ARITY = 4096  # fixed value: children of a node of the digest
CONTENTS = {
    "line": b"a", "break": b"a\n", "breaks": b"\n\n", "crlf": b"a\r\nb\r\n", "utf8": "é|ü\n".encode() * 3000,
    "last": b"x\n" * 5000 + "é".encode("latin-1"), "cut": b"x\n" * 5000 + "é".encode()[:1], "mark": codecs.BOM_UTF8 + b"a\nb",
    "mark_break": codecs.BOM_UTF8 + b"a\n", "mark_bad": codecs.BOM_UTF8 + b"a\n\xff\n", "only_mark": codecs.BOM_UTF8,
    "le": "id|t\n1|é\n".encode("utf-16"), "be": codecs.BOM_UTF16_BE + "id\n1\n".encode("utf-16-be"), "inner": b"a\n\xff\xfeb\n",
    "many": b"".join(b"%d\n" % i for i in range(9000)), "long": b"y" * 50_000 + b"\nz", "zero": b"\x00\n\x00",
}


@pytest.fixture
def folder(spark, tmp_path):
    for name, content in CONTENTS.items():
        (tmp_path / f"{name} +%41.txt").write_bytes(content)
    before = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, "4k")
    yield str(tmp_path)
    spark.conf.set(SPLIT, before)


def encoding_of(content: bytes) -> str:
    if content.startswith(codecs.BOM_UTF8):
        return "UTF-8"
    if content.startswith((codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)):
        return "UTF-16"
    try:
        content.decode()
        return "UTF-8"
    except UnicodeDecodeError:
        return "ISO-8859-1"


def digest_of(content: bytes) -> str:
    def sha(data):
        return hashlib.sha256(data).hexdigest()

    level = [sha(line) for line in content.removeprefix(codecs.BOM_UTF8).removesuffix(b"\n").split(b"\n")]
    for _ in range(4):
        level = [sha("".join(level[i : i + ARITY]).encode()) for i in range(0, len(level), ARITY)]
    some = content.removeprefix(codecs.BOM_UTF8)
    return sha(f"{len(content)}:{level[0] if some else ''}".encode())


def name_of(row) -> str:
    return row["filename"].split(" ")[0]


def test_encodings_of_files_in_splits(spark, folder):
    found = listing.detect_encoding(spark, folder)
    assert {name_of(r): r["encoding"] for r in found.collect()} == {n: encoding_of(c) for n, c in CONTENTS.items()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "SortAggregate" not in plan


def test_digests_do_not_depend_on_splits(spark, folder):
    expected = {n: digest_of(c) for n, c in CONTENTS.items()}
    assert len(set(expected.values())) == len(CONTENTS)
    assert {name_of(r): r["digest"] for r in listing.digest_files(spark, folder).collect()} == expected
    spark.conf.set(SPLIT, "128m")
    assert {name_of(r): r["digest"] for r in listing.digest_files(spark, folder, "*.txt").collect()} == expected


def test_files_of_every_encoding_are_read(spark, folder):
    heads = {r["path"].rsplit("/", 1)[-1].split(" ")[0]: r["line"] for r in files.file_heads(spark, folder, "auto").collect()}
    assert heads["le"] == "id|t" and heads["be"] == "id" and heads["mark"] == "a" and heads["utf8"] == "é|ü"


def test_one_big_file_is_read_by_many_tasks(spark, folder):
    from millrace.sources.lines import byte_lines

    lines = byte_lines(spark, folder, pathGlobFilter="many*")
    assert lines.rdd.getNumPartitions() > 4
    assert lines.select("split").distinct().count() > 4
