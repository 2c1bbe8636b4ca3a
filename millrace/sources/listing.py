"""Directory listings as tables, file hashes and encodings."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import base_name, human_size, parent_path
from millrace.sources.lines import digests, encodings
from millrace.sources.streams import chunks_of


def list_directory(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """Files with parent, name, time and size; contents are never read. Spark lists no empty files.

    Sorting is left to the caller (``orderBy`` on ``last_modified_dt``).
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        parent_path("path").alias("parent_path"),
        base_name("path").alias("filename"),
        F.col("modificationTime").cast("timestamp_ntz").alias("last_modified_dt"),
        human_size("length").alias("file_size"),
        F.col("length").alias("st_size"),
        F.unix_timestamp("modificationTime").alias("st_mtime"),
    )


def list_with_fallback(primary: DataFrame, archive: DataFrame) -> DataFrame:
    """``primary``, or ``archive`` if ``primary`` has no row."""
    found = primary.agg(F.count("*")).scalar()
    return primary.unionByName(archive.where(found == 0))


def _hash_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import hashlib

    for batch in batches:
        digests = []
        for parent, name in zip(batch["parent_path"], batch["filename"]):
            digest = hashlib.blake2b()
            for chunk in chunks_of(f"{parent}/{name}"):
                digest.update(chunk)
            digests.append(digest.hexdigest())
        yield batch.assign(hash_check_sum=digests)


def hash_files(listing: DataFrame) -> DataFrame:
    """Listing with the BLAKE2b of every file, read in chunks of fixed size inside the tasks.

    Files of any size fit, and the listing is spread so that big files hash side by side.
    """
    slots = listing.sparkSession.sparkContext.defaultParallelism
    schema = T.StructType([*listing.schema.fields, T.StructField("hash_check_sum", T.StringType())])
    return listing.repartition(slots, "parent_path", "filename").mapInPandas(_hash_batches, schema)


def _with_facts(listed: DataFrame, path: Column | str, facts: DataFrame) -> DataFrame:
    """``listed`` with the facts of each file; those of files without a line are null."""
    key = F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")
    return listed.withColumn("_key", key).join(facts.withColumnRenamed("path", "_key"), "_key", "left").drop("_key")


def with_encoding(listed: DataFrame, path: Column | str, found: DataFrame) -> DataFrame:
    """``listed`` with the ``encoding`` that ``lines.encodings`` found; files without a line are UTF-8."""
    return _with_facts(listed, path, found).fillna("UTF-8", "encoding")


def _options(pattern: str | None, recursive: bool) -> dict:
    return {"recursiveFileLookup": recursive} | ({"pathGlobFilter": pattern} if pattern else {})


def detect_encoding(
    spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False, fallback: str = "ISO-8859-1"
) -> DataFrame:
    """:func:`list_directory` with ``encoding``: byte order mark, else valid UTF-8, else ``fallback``."""
    found = encodings(spark, path, fallback, **_options(pattern, recursive))
    return with_encoding(list_directory(spark, path, pattern, recursive), F.concat_ws("/", "parent_path", "filename"), found)


def digest_files(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """:func:`list_directory` with ``digest``: SHA-256 of the size and the digest of the lines.

    Size and lines tell any two plain files apart, also by a last line break or a byte order mark. Big files
    are hashed by many tasks; see :func:`millrace.sources.lines.digests`.
    """
    found = digests(spark, path, **_options(pattern, recursive))
    listed = _with_facts(list_directory(spark, path, pattern, recursive), F.concat_ws("/", "parent_path", "filename"), found)
    whole = F.concat(F.col("st_size").cast("string"), F.lit(":"), F.coalesce("tree", F.lit("")))
    return listed.withColumn("digest", F.sha2(whole, 256)).drop("tree")
