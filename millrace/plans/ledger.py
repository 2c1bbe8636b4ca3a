"""Which files a table's slices hold rows of: a small parquet ledger beside the table.

A row is (file, slice, rows); ``file`` is the path where the table knows it, else the name. Entries are
written before the rows they speak of, and removed after these are gone, so that a slice with rows of a
file is always listed, whenever a run dies. Generations make a rewrite whole: the newest complete one
counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.refresh import file_keys
from millrace.session import delete_path, hadoop_path

ENTRY = "file string, slice date, rows bigint"


class FileLedger:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _generations(self) -> list[int]:
        """Complete generations, ascending."""
        fs, root = hadoop_path(self.spark, self.folder)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n[1:]) for n in names if fs.exists(hadoop_path(self.spark, f"{self.folder}/{n}/_SUCCESS")[1]))

    def _path(self, generation: int) -> str:
        return f"{self.folder}/g{generation}"

    @property
    def exists(self) -> bool:
        return bool(self._generations())

    def read(self) -> DataFrame:
        found = self._generations()
        return self.spark.read.schema(ENTRY).parquet(self._path(found[-1])) if found else self.spark.createDataFrame([], ENTRY)

    def add(self, entries: DataFrame) -> None:
        """Entries of rows that are about to be written."""
        if self.exists:
            entries.write.mode("append").parquet(self._path(self._generations()[-1]))
        else:
            self.rewrite(entries)

    def rewrite(self, entries: DataFrame) -> None:
        """A new generation with these entries; it may be derived from the present one."""
        old = self._generations()
        number = max(old, default=0) + 1
        entries.write.mode("overwrite").parquet(self._path(number))
        for generation in old:
            delete_path(self.spark, self._path(generation))

    def without(self, slices: Column) -> DataFrame:
        """Entries of all other slices."""
        return self.read().where(~F.coalesce(slices, F.lit(False)))


def entries(rows: DataFrame, slice_column: str | None) -> DataFrame:
    """Entries of table rows; rows without any file have none."""
    keys = [k for k in file_keys(rows.columns)]
    when = F.col(slice_column) if slice_column else F.lit(None).cast("date")
    listed = rows.select(F.explode(F.array_distinct(F.array(*keys))).alias("file"), when.alias("slice")).where("file IS NOT NULL")
    return listed.groupBy("file", "slice").agg(F.count("*").alias("rows"))
