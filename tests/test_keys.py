"""Key sketches: upserts open only slices that can hold a key."""

import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators.refresh import upsert
from millrace.plans.keys import KeySketches, _bit_set
from millrace.plans.table import SLICE, WarehouseTable, ensure_database
from millrace.session import scratch_dir


@pytest.fixture
def db(spark):
    name = f"k_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, name, scratch_dir(spark, name))
    return name


def made(spark, keys, shift=0):
    """100 keys a month."""
    rows = [(k, f"u{k * 7919 % 1000:03}", dt.datetime(2024, 1 + k // 100, 5), k + shift) for k in keys]
    return spark.createDataFrame(rows, "k int, u string, d timestamp_ntz, v int")


def everything(table):
    return sorted(map(repr, table.read().collect()))


def spoil(table, but):
    """Make the data of all other slices unreadable."""
    for part in Path(table._location().removeprefix("file:")).glob("SLICE_START=*"):
        if part.name.split("=")[1] not in but:
            for file in part.glob("*.parquet"):
                file.write_bytes(b"")
            for crc in part.glob(".*.crc"):
                crc.unlink()


@pytest.mark.parametrize(("keys", "step"), [(["k"], 1), (["u"], 1), (["u", "k"], 1)])
def test_upserts_of_one_slice_open_one_slice(spark, db, keys, step):
    table = WarehouseTable(spark, f"{db}.t", "d")
    table.append(made(spark, range(900)))
    sketches = KeySketches(spark, f"{table._location()}.keys", keys, SLICE)
    sketches.learn(table._rows())
    few = made(spark, [310, 311], shift=5)
    assert sketches.slices(table._rows(), few.select(*keys)) == {dt.date(2024, 4, 1)}
    spoil(table, {"2024-04-01"})
    table.upsert(few, keys)
    assert {r.k: r.v for r in table.scan("2024-04-01", "2024-05-01").collect()} == {k: k + 5 * (k in (310, 311)) for k in range(300, 400)}


def test_sketches_follow_appends_moves_and_nulls(spark, db):
    table, expected = WarehouseTable(spark, f"{db}.t", "d"), made(spark, range(0, 600, 3))
    table.append(expected)
    batches = [
        made(spark, [3, 4, 599], 1),
        spark.createDataFrame([(3, "moved", dt.datetime(2024, 12, 1), 0), (None, "null", None, 1), (None, "null", None, 1)], expected.schema),
        made(spark, [3, 450], 2),
        made(spark, range(0, 600, 2), 9),
    ]
    for batch in batches:
        expected = upsert(expected, batch, ["k"])
        table.upsert(batch, ["k"])
        more = made(spark, [1000 + expected.count() % 97], 7).withColumn("d", F.lit(dt.datetime(2024, 2, 2)).cast("timestamp_ntz"))
        table.append(more)
        expected = expected.unionByName(more)
        assert everything(table) == sorted(map(repr, expected.collect()))


def test_many_keys_fall_back_to_the_key_column(spark, db):
    table = WarehouseTable(spark, f"{db}.t", "d")
    table.append(made(spark, range(900)))
    sketches = KeySketches(spark, f"{table._location()}.keys", ["u"], SLICE)
    assert sketches.slices(table._rows(), made(spark, range(900)).select("u")) is None
    table.upsert(made(spark, range(0, 900, 2), 3), ["u"])
    assert len({r.u for r in table.read().collect()}) == table.read().count()


def test_bits_of_bitmaps(spark):
    bits = [0, 7, 8, 1000, 32767]
    row = spark.createDataFrame([(b,) for b in bits], "b long").agg(F.bitmap_construct_agg("b").alias("m"))
    found = row.select(*[_bit_set("m", F.lit(b)).alias(str(b)) for b in (*bits, 1, 9, 999, 32766)]).first()
    assert list(found) == [True] * 5 + [False] * 4


def test_nothing_to_look_through(spark, db):
    table = WarehouseTable(spark, f"{db}.t", "d")
    table.create(made(spark, [1]).schema)
    assert table.upsert(made(spark, [1, 2]), ["k"]) == 2
    assert table.upsert(made(spark, [5]).where("false"), ["k"]) == 0 and table.read().count() == 2
