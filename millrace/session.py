"""Session helpers: shared scratch space and file-system access."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a single-machine session
    (``local[n]``) without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[context.applicationId] = tempfile.mkdtemp(prefix="millrace-")
    return _LOCAL_SCRATCH[context.applicationId]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under :func:`scratch_root`; nothing is created yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) pair of the Hadoop API for ``path``."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = hadoop_path(spark, path)
    return fs.exists(jvm_path)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = hadoop_path(spark, path)
    return fs.delete(jvm_path, True)


def unstage(df: DataFrame) -> None:
    """Delete what :func:`stage` wrote, once nothing reads it any more."""
    for file in df.inputFiles()[:1]:
        delete_path(df.sparkSession, file.rsplit("/", 1)[0])


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Several later passes (bounds, affected slices, the write itself) then read columnar
    files instead of the source again, and a lost executor cannot trigger a re-read of it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
