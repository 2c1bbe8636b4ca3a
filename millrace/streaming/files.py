"""Files as a stream: new ones by Spark's own log, changed ones by a state of versions."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from millrace.operators.refresh import Mode, RefreshSpec, row_path
from millrace.plans.table import WarehouseTable


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files: int | None = None,
    latest_first: bool = False,
    **options,
) -> DataFrame:
    """Stream of the files in a folder, each row with its FILE_NAME and FILE_PATH.

    A batch takes all files that are there, or at most ``max_files``; the others follow.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.option("latestFirst", latest_first).options(**options).load(path)
    return rows.withColumns({"FILE_NAME": F.col("_metadata.file_name"), "FILE_PATH": row_path()})


def ingest_stream(stream: DataFrame, table: WarehouseTable, checkpoint: str) -> StreamingQuery:
    """Load all files not seen yet, then stop.

    A batch that is replayed after a failure replaces the rows of its own files, so every
    file ends up in the table once.
    """
    spec = RefreshSpec(ingest_type=Mode.CDC)

    def load(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            table.refresh(batch, spec)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# files that change


VERSION = "seq long, parent_path string, filename string, st_mtime long, st_size long"
CHANGED = "parent_path string, filename string, st_mtime long, st_size long"


def _last_version(key, frames, state):
    """The file's last version if it is another than the one kept before."""
    last = None
    for frame in frames:
        newest = frame.loc[frame["seq"].idxmax()]
        if last is None or newest["seq"] > last["seq"]:
            last = newest
    version = (int(last["st_mtime"]), int(last["st_size"]))
    if not state.exists or state.get != version:
        state.update(version)
        yield pd.DataFrame({"parent_path": [last["parent_path"]], "filename": [last["filename"]], "st_mtime": [version[0]], "st_size": [version[1]]})


def changed_files(listings: DataFrame) -> DataFrame:
    """Stream of the files that are new or changed, from a stream of listings (``VERSION``; ``seq`` rises).

    The state keeps the last version of each path, time and size, and nothing else: it grows with the
    paths, not with the runs or the rows of any table.
    """
    keyed = listings.withColumn("_path", F.concat_ws("/", "parent_path", "filename"))
    return keyed.groupBy("_path").applyInPandasWithState(_last_version, CHANGED, "st_mtime long, st_size long", "update", GroupStateTimeout.NoTimeout)


def ingest_changed(
    listing: DataFrame,
    table: WarehouseTable,
    folder: str,
    read: Callable[[list[str]], DataFrame],
) -> StreamingQuery:
    """Load the files of ``listing`` that are new or changed since the last run, then stop.

    ``folder`` keeps the feed of listings and the checkpoint. ``read`` gives the rows of some paths; they
    get FILE_NAME and FILE_PATH from it (see ``read_files``). A changed file replaces its own rows, found
    by path, so a batch that is replayed after a failure is harmless.
    """
    spark = listing.sparkSession
    seen = listing.select(F.lit(time.time_ns()).alias("seq"), "parent_path", "filename", "st_mtime", "st_size")
    seen.write.mode("append").parquet(f"{folder}/feed")
    feed = spark.readStream.schema(VERSION).option("cleanSource", "delete").parquet(f"{folder}/feed")

    def load(batch: DataFrame, _: int) -> None:
        paths = [r[0] for r in batch.select(F.concat_ws("/", "parent_path", "filename")).collect()]
        if paths:
            table.refresh(read(paths), RefreshSpec(ingest_type=Mode.CDC, file_paths=paths))

    return (
        changed_files(feed).writeStream.foreachBatch(load)
        .outputMode("update")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
