"""Encodings and digests of files, from their lines as bytes.

Files are read in splits and cut at the byte ``0A`` alone, so many tasks read one big file and nothing
is decoded. A line is held whole by its task. Compressed files are looked at unpacked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.joins import join_groups
from millrace.operators.refresh import row_path
from millrace.session import stage, unstage

ARITY = 4096
LEVELS = 4
COMPRESSED = r"\.(gz|bz2|deflate|zst|lz4|snappy)$"  # fixed values: endings by which Spark unpacks


def byte_lines(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """``path``, ``size``, ``split``, ``at`` (ascending within a split, without gaps) and ``value``."""
    given = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.options(lineSep="\n", **options).text(given).select(
        row_path().alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), "value",
    )


def encodings(spark: SparkSession, paths: str | Sequence[str], fallback: str = "ISO-8859-1", **options) -> DataFrame:
    """``path`` and ``encoding``: byte order mark, else valid UTF-8, else ``fallback``; files without a line have no row.

    No character of UTF-8 has the byte of a line break inside it, so a file is valid if its lines are.
    The reader takes a mark of UTF-8 off the first line; three bytes are then missing in the sum of the
    lines, which files without a line break at the end exceed by one. Compressed files have no such sum,
    so they go by validity.
    """
    lines = byte_lines(spark, paths, **options)
    first = F.when(F.col("split") == 0, F.col("at"))
    wide = F.substring(F.col("value").cast("binary"), 1, 2).isin(F.unhex(F.lit("FFFE")), F.unhex(F.lit("FEFF")))
    files = lines.groupBy("path").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("valid"),
        (F.max("size") - F.sum(F.octet_length("value") + F.lit(1).cast("long"))).alias("left"),
        F.min(first).alias("head"), F.min(F.when(wide, first)).alias("wide"),
    )
    marked = (F.col("left") > 1) & ~F.col("path").rlike(COMPRESSED)
    encoding = F.when(marked, "UTF-8").when(F.col("wide") == F.col("head"), "UTF-16")
    return files.select("path", encoding.when(F.col("valid"), "UTF-8").otherwise(fallback).alias("encoding"))


def _numbered(leaves: DataFrame) -> DataFrame:
    """Lines with their number in the file, by the counts of the splits before theirs."""
    splits = leaves.groupBy("path", "split").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("path", "split", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    placed = join_groups(leaves, splits, ["path", "split"], "inner")
    return placed.select("path", (F.col("at") + F.col("shift")).alias("number"), "digest")


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def digests(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """``path`` and ``tree``, a digest of the lines of each file that has any, as hex.

    A tree of SHA-256: leaves are lines, a node is the digest of the joined hex of its ``ARITY`` children,
    ``LEVELS`` nodes above every line (2**48 lines). So a file's digest depends neither on splits nor on
    other files, and one file is hashed by many tasks; 32 bytes a line are shuffled, and no
    task holds more than the children of its nodes. Leaves are staged, and deleted once the trees are.
    """
    leaf = F.unhex(F.sha2(F.col("value").cast("binary"), 256)).alias("digest")
    leaves = stage(byte_lines(spark, paths, **options).select("path", "split", "at", leaf), "leaves")
    level = _numbered(leaves)
    for _ in range(LEVELS):
        children = F.array_sort(F.collect_list(F.struct("number", "digest")))
        level = level.groupBy("path", F.floor(F.col("number") / ARITY).alias("node")).agg(children.alias("children"))
        joined = F.array_join(F.transform("children", lambda c: _hex(c["digest"])), "")
        level = level.select("path", F.col("node").alias("number"), F.unhex(F.sha2(joined, 256)).alias("digest"))
    trees = stage(level.select("path", _hex(F.col("digest")).alias("tree")), "trees")
    unstage(leaves)
    return trees
