"""One key or slice with a third of all rows: the work is split, the result stays whole."""

import contextlib
import uuid

import pytest
from pyspark.sql import functions as F

from millrace.operators.changes import latest_per_key, retention_expired
from millrace.operators.refresh import Slice
from millrace.operators.relational import group_bounds, join_aggregate, text_lists
from millrace.plans.table import SLICE, WarehouseTable, ensure_database
from millrace.session import scratch_dir, scratch_root
from millrace.sources.listing import list_directory

N = 600_000


@contextlib.contextmanager
def settings(spark, **values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows has key 0, the others are spread."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.hash("id") % 5000)
    path = scratch_dir(spark, "hot")
    spark.range(0, N, 1, 16).select(key.alias("k"), "id", F.concat(F.lit("f"), key.cast("string")).alias("FILE_NAME")).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect() if df.count() < 10 else None
    qe = df._jdf.queryExecution()
    qe.executedPlan().execute().count()
    return qe.executedPlan().toString()


def test_hot_group_bounds_join_is_split(spark, hot):
    with settings(spark, **SMALL):
        out = group_bounds(hot, ["k"], "id", "id")
        assert "skew=true" in final_plan(out)
        assert out.count() == N


def test_hot_retention_join_is_split(spark, hot):
    with settings(spark, **SMALL):
        out = retention_expired(hot, ["k"], ["id"], 2)
        assert "skew=true" in final_plan(out)
        keys = hot.select("k").distinct().count()
        singles = hot.groupBy("k").count().where("count = 1").count()
        assert out.count() == N - 2 * keys + singles


def test_hot_file_anti_join_is_split(spark, hot):
    names = hot.where("k > 0").select(F.col("FILE_NAME").alias("name")).distinct()
    with settings(spark, **SMALL):
        out = Slice(names=names, name_columns=("FILE_NAME",)).survivors(hot)
        assert "skew=true" in final_plan(out)
        assert out.count() == hot.where("k <= 0").count()


def test_hot_key_is_aggregated_before_the_shuffle(spark, hot):
    plan = latest_per_key(hot, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_hot_slice_is_written_by_several_tasks(spark, hot):
    db = f"s_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, db, scratch_dir(spark, db))
    t = WarehouseTable(spark, f"{db}.t", "d")
    day = F.when(F.col("k") == 0, F.lit("2024-01-05")).otherwise(F.concat(F.lit("2024-0"), (F.col("id") % 8 + 2).cast("string"), F.lit("-01")))
    with settings(spark, **SMALL):
        assert t.append(hot.withColumn("d", day.cast("timestamp_ntz"))) == N
    files = list_directory(spark, t._location(t.name), "*.parquet", recursive=True)
    counts = {r[0]: r[1] for r in files.groupBy(F.regexp_extract("parent_path", f"{SLICE}=(.*)$", 1)).count().collect()}
    assert len(counts) == 9
    assert counts["2024-01-01"] >= 2
    assert t.read().count() == N


class FakeSession:
    """A session without the scratch setting."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": master})


def test_scratch_folder_is_the_configured_one_or_local_only(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert scratch_dir(spark, "x").startswith(configured.rstrip("/"))
    local = FakeSession("local[2]")
    assert scratch_root(local) == scratch_root(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(FakeSession("yarn"))


def test_text_lists_of_a_hot_group_lie_in_many_tasks(spark, hot):
    """Pieces of the hot group come from all ranges; a text that a third of all rows share is spread by key."""
    texts = hot.select("k", F.when(F.col("id") % 4 == 0, "hot").otherwise(F.col("id").cast("string")).alias("t"))
    with settings(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        found = {r["k"]: r["l"] for r in text_lists(texts, ["k"], "t", "l", "|").collect()}
        once = texts.groupBy("k", "t").count().repartitionByRange("t", "k").groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in once.collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)
    rows = {}
    for k, t in texts.collect():
        rows.setdefault(k, []).append(t)
    assert found == {k: "|".join(sorted(v)) for k, v in rows.items()}


def test_text_lists_keep_nulls_and_blanks_apart(spark):
    details = spark.createDataFrame([(1, "b"), (1, ""), (1, None), (2, None), (3, "é"), (3, "z"), (None, "n")], "k int, t string")
    left = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "k int")
    out = {r["k"]: r["l"] for r in join_aggregate(left, details, ["k"], "t", "l").collect()}
    assert out == {1: ",b", 2: "", 3: "z,é", 4: None, None: None}
    assert text_lists(details.where("false"), ["k"], "t", "l").count() == 0
