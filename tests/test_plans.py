"""Shape of the physical plans: what must hold at any size of the data."""

import pytest

from warehouse_queries import QUERIES

# Queries whose feature is a hash or a file format the JVM side lacks.
PYTHON = {"file_hashes"}
# Round trips run jobs when called; their result is a plain scan.
ACTIONS = ("table_", "job_", "_roundtrip", "partition_purge", "swap_", "stream_", "event_rows", "directory_", "_scan", "folder_mixed", "encoding_choice", "archive_fallback", "month_driver", "catalog_metadata", "view_set",
           "multi_path", "sampled", "delimiter", "delimited", "parquet", "lineage_closure", "lineage_impact", "file_hashes")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not any(a in n for a in ACTIONS)))
def test_no_python_rows_and_no_products(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "BatchEvalPython" not in plan
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON:
        assert "Python" not in plan and "InPandas" not in plan


def test_flagship_reads_five_columns_and_pushes_its_filter(spark, sf_dir):
    plan = plan_of(QUERIES["monthly_sales"](spark, sf_dir))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    columns = scan.split("[", 1)[1].split("]", 1)[0]
    assert {c.split("#")[0] for c in columns.split(",")} == {
        "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate",
    }
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("name", ["refresh_mtd", "refresh_n_days_window", "refresh_partition"])
def test_slice_refreshes_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, sf_dir))


def test_file_refresh_shuffles_only_the_names_of_the_batch(spark, sf_dir):
    """Names are joined, not collected; below Spark's size threshold they are broadcast to the target."""
    plan = plan_of(QUERIES["refresh_cdc_file"](spark, sf_dir))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["partition_number", "text_month_to_date", "parse_date_pattern", "human_size", "tz_shift"])
def test_column_functions_stay_in_one_generated_stage(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "Exchange" not in plan and plan.startswith("*(1)")


def test_newest_rows_are_limited_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["retention_expired"](spark, sf_dir))
    assert "WindowGroupLimit" in plan
    partial = [line for line in plan.splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    assert partial


@pytest.mark.parametrize("name", ["latest_per_key", "run_bounds_window", "scd2_delta", "scd2_dimension"])
def test_no_window_over_whole_groups(spark, sf_dir, name):
    assert "Window" not in plan_of(QUERIES[name](spark, sf_dir))
