"""Which files of a table may hold some keys: a range and a Bloom filter for each data file.

Data files never change, so a sketch made once holds for as long as its file is part of the table: there
is nothing to keep in step with writes. Files without a sketch are looked at once, their key columns
only. A sketch has the range of the first key and a blocked Bloom filter: a key chooses one block of
``BLOCK_BITS`` bits (a bitmap of Spark's ``bitmap_construct_agg``) and ``HASHES`` bits in it.

Sketches are two parquet folders beside the table. The bits are written before the ranges, and only a
file in the ranges counts as known, so a run that dies in between is simply repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.changes import plain
from millrace.operators.refresh import plain_path
from millrace.session import path_exists

BLOCK_BITS = 32768  # fixed value: bits of one bitmap
HASHES = 4
BITS_A_KEY = 12


class KeySketches:
    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], slice_column: str) -> None:
        self.spark, self.keys, self.slice_column = spark, list(keys), slice_column
        self.folder = f"{folder}/{'-'.join(k.lower() for k in keys)}"

    def _read(self, part: str) -> DataFrame | None:
        path = f"{self.folder}/{part}"
        return self.spark.read.parquet(path) if path_exists(self.spark, path) else None

    def _hash(self) -> Column:
        return F.xxhash64(*self.keys)

    @staticmethod
    def _block(hashed: Column, blocks: Column) -> Column:
        return F.pmod(F.shiftrightunsigned(hashed, 32), blocks).cast("int")

    @staticmethod
    def _bits(hashed: Column) -> list[Column]:
        """Bits of a key in its block, by hashing the hash again."""
        return [F.pmod(F.xxhash64(F.lit(i), hashed), F.lit(BLOCK_BITS)) for i in range(HASHES)]

    def learn(self, rows: DataFrame) -> None:
        """Sketch the files of ``rows`` (a plain scan) that are not known yet."""
        held = self._read("ranges")
        known = set() if held is None else {r["file"] for r in held.select("file").toLocalIterator()}
        fresh = [f for f in rows.inputFiles() if plain_path(f) not in known]
        if not fresh:
            return
        at = F.col("_metadata.file_path")
        part = rows.select(*self.keys, self.slice_column, plain(at).alias("file"), at.alias("_at"))
        if known:  # prunes files before they are opened; readers write one or three slashes
            part = part.where(F.col("_at").isin([*fresh, *map(plain_path, fresh)]))
        part = part.drop("_at").withColumn("hash", self._hash())
        first = self.keys[0]
        blocks = F.ceil(F.count("*") * BITS_A_KEY / F.lit(BLOCK_BITS)).cast("int")
        ranges = part.groupBy("file", F.col(self.slice_column).alias("slice")).agg(
            F.count("*").alias("rows"), F.min(first).alias("low"), F.max(first).alias("high"), F.count_if(F.col(first).isNull()).alias("nulls"), blocks.alias("blocks")
        )
        size = ranges.select("file", "blocks")
        bits = part.select("file", "hash").join(size, "file").select("file", self._block(F.col("hash"), F.col("blocks")).alias("block"), F.explode(F.array(*self._bits(F.col("hash")))).alias("bit"))
        bits.groupBy("file", "block").agg(F.bitmap_construct_agg("bit").alias("bitmap")).write.mode("append").parquet(f"{self.folder}/bits")
        ranges.write.mode("append").parquet(f"{self.folder}/ranges")

    def _current(self, rows: DataFrame) -> DataFrame:
        files = [(plain_path(f),) for f in rows.inputFiles()]
        return self._read("ranges").distinct().join(self.spark.createDataFrame(files, "file string"), "file", "left_semi")

    def slices(self, rows: DataFrame, chosen: DataFrame) -> set | None:
        """Slices that may hold one of the ``chosen`` keys (distinct, not null); None if looking through
        the sketches would take more steps than the table has rows.
        """
        if not rows.inputFiles():
            return set()
        self.learn(rows)
        ranges = self._current(rows)
        by_slice = ranges.groupBy("slice").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("rows"), F.count("*").alias("files")).collect()
        spans = [r for r in by_slice if r["low"] is not None]
        if not spans:
            return set()
        kind = rows.schema[self.keys[0]].dataType
        listed = F.array(*[F.struct(F.lit(i).alias("i"), _literal(r["low"], kind).alias("low"), _literal(r["high"], kind).alias("high")) for i, r in enumerate(spans)])
        first = F.col(self.keys[0]).cast(kind)
        within = F.filter(listed, lambda r: (first >= r["low"]) & (first <= r["high"]))
        typed = chosen.select(*[F.col(k).cast(rows.schema[k].dataType).alias(k) for k in self.keys]).where(reduce(Column.__and__, [F.col(k).isNotNull() for k in self.keys]))
        pairs = typed.select(self._hash().alias("hash"), F.col(self.keys[0]).alias("first"), F.explode(F.transform(within, lambda r: r["i"])).alias("i"))
        steps = {r["i"]: r["n"] for r in pairs.groupBy("i").agg(F.count("*").alias("n")).collect()}
        if sum(n * spans[i]["files"] for i, n in steps.items()) > sum(r["rows"] for r in spans):
            return None
        numbered = self.spark.createDataFrame([(i, r["slice"]) for i, r in enumerate(spans)], T.StructType([T.StructField("i", T.IntegerType()), T.StructField("slice", ranges.schema["slice"].dataType)]))
        near = pairs.join(numbered, "i").join(ranges.withColumnRenamed("slice", "_s"), F.col("slice").eqNullSafe(F.col("_s")) & F.col("first").between(F.col("low"), F.col("high")))
        near = near.select("slice", "file", "hash", self._block(F.col("hash"), F.col("blocks")).alias("block"))
        tested = near.join(self._read("bits"), ["file", "block"]).where(reduce(Column.__and__, [_bit_set("bitmap", b) for b in self._bits(F.col("hash"))]))
        return {r["slice"] for r in tested.select("slice").distinct().collect()}


def _literal(value, kind: T.DataType) -> Column:
    return F.lit(value).cast(kind)


def _bit_set(bitmap: str, bit: Column) -> Column:
    """Whether a bit of a bitmap is set: byte ``bit / 8``, the lowest bit first."""
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, (bit % 8).cast("int")) == 1
