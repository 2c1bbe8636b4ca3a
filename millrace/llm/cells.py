"""All pairs of a group without one task that holds the group.

Members of a group are dealt into sub-blocks of about ``limit`` members; a *cell* holds one or
two sub-blocks, so every pair of members meets in exactly one cell and a cell has a bounded size.
Cells are gathered into bins, so that a task handles many small cells at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import join_groups


def cells(members: DataFrame, group: list[str], member: str, limit: int) -> DataFrame:
    """Adds ``cell`` (a hash of group and sub-blocks), ``sub`` (the own sub-block) and ``split``
    (whether the cell holds two sub-blocks). Groups of one member are left out.
    """
    sizes = members.groupBy(*group).agg(F.count("*").alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / F.lit(limit)).cast("int")
    dealt = join_groups(members, sizes, group, "inner").withColumn("sub", F.pmod(F.xxhash64(F.lit(17), member), blocks).cast("int"))
    dealt = dealt.withColumn("_x", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.select(
        *members.columns,
        "sub",
        (F.col("_x") != F.col("sub")).alias("split"),
        F.xxhash64(*group, F.least("_x", "sub"), F.greatest("_x", "sub")).alias("cell"),
    )


def binned(placed: DataFrame, per_bin: int, rows: int) -> DataFrame:
    """Rows with a column ``bin`` of whole cells; about ``per_bin`` rows share one."""
    bins = max(1, -(-rows // per_bin))
    return placed.withColumn("bin", F.pmod(F.col("cell"), F.lit(bins)).cast("int")).repartition(bins, "bin")
