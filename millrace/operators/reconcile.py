"""Counts per month and comparison of two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import month_start


def month_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per month; NULL dates do not count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(month_start(column).alias("month"))
        .agg(F.count("*").alias("row_num"))
    )


def distinct_months(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Months present, as ``yyyy-MM-01`` text, sorted."""
    months = df.where(F.col(column).isNotNull()).select(F.date_format(column, "yyyy-MM-'01'").alias("month")).distinct()
    return months.orderBy(F.desc("month") if descending else F.asc("month"))


def month_mismatch(old: DataFrame, new: DataFrame, column: str, both_sides: bool = False) -> DataFrame:
    """Months whose counts differ. ``both_sides`` also reports months only ``new`` has.

    Both sides are aggregated first, so the join only sees one row per month.
    """
    left = month_counts(old, column).withColumnRenamed("row_num", "old_rows")
    right = month_counts(new, column).withColumnRenamed("row_num", "new_rows")
    joined = left.join(right, "month", "full_outer" if both_sides else "left")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("old_rows", "new_rows")}
    return joined.withColumns(counts).where(F.col("old_rows") != F.col("new_rows"))


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row's values and of which of them are NULL, whatever the order of ``columns``.

    The hash alone passes over NULLs, so a value that moves to a neighbour would not show.
    """
    columns = sorted(columns)
    return F.xxhash64(*columns, *[F.isnull(c) for c in columns])


def _digest(columns: Sequence[str]) -> Column:
    """Order-free digest of a group of rows; decimal, because 64-bit hashes would overflow a long sum."""
    return F.sum(row_hash(columns).cast("decimal(38,0)"))


def content_mismatch(old: DataFrame, new: DataFrame, by: Column) -> DataFrame:
    """Values of ``by`` (NULL too) whose rows differ: ``part``, ``old_rows``, ``new_rows``.

    Both sides have the same columns. Each side is one partial aggregate to a count and a digest for
    each value, so rows stay where they are; equal counts with other content are found.
    """

    def digests(df: DataFrame, side: str) -> DataFrame:
        sums = [F.count("*").alias(f"{side}_rows"), _digest(old.columns).alias(f"{side}_digest")]
        return df.groupBy(by.alias(f"_{side}")).agg(*sums)

    left, right = digests(old, "old"), digests(new, "new")
    both = left.join(right, F.col("_old").eqNullSafe(F.col("_new")), "full_outer")
    differ = ~F.col("old_rows").eqNullSafe(F.col("new_rows")) | ~F.col("old_digest").eqNullSafe(F.col("new_digest"))
    counts = [F.coalesce(f"{side}_rows", F.lit(0).cast("bigint")).alias(f"{side}_rows") for side in ("old", "new")]
    return both.where(differ).select(F.coalesce("_old", "_new").alias("part"), *counts)


def row_differences(old: DataFrame, new: DataFrame, parts: int = 4096) -> DataFrame:
    """Rows that one side holds more often than the other, with ``old_rows`` and ``new_rows``.

    Two steps: the digests of ``parts`` ranges of row hashes tell where the sides differ, then only rows
    of these ranges are shuffled and counted one by one. Equal tables shuffle digests alone; a few
    changed rows bring the rows of as many ranges. The ranges cut by content, so a value that a third of
    all rows share makes no range hot; rows equal in all columns meet as one after the partial count.
    The list of differing ranges is broadcast: it has ``parts`` numbers at most.
    """
    if not 1 <= parts <= 1 << 16:
        raise ValueError(f"parts must be 1 to {1 << 16}")
    columns = old.columns
    part = F.pmod(F.shiftrightunsigned(row_hash(columns), 40), F.lit(parts))
    wrong = content_mismatch(old, new, part).select(F.col("part").alias("_part"))

    def counted(df: DataFrame, side: str) -> DataFrame:
        rows = df.select(columns).withColumn("_part", part).join(F.broadcast(wrong), "_part", "left_semi").drop("_part")
        both = {"old": F.lit(0), "new": F.lit(0)} | {side: F.lit(1)}
        return rows.withColumns({f"{s}_rows": one for s, one in both.items()})

    rows = counted(old, "old").unionByName(counted(new, "new"))
    found = rows.groupBy(*columns).agg(*[F.sum(f"{s}_rows").alias(f"{s}_rows") for s in ("old", "new")])
    return found.where("old_rows != new_rows")


def reconcile_totals(old: DataFrame, new: DataFrame, content: bool = False) -> DataFrame:
    """Row counts of both versions and a verdict; ``content`` also compares a row hash sum.

    Each side is one partial aggregate; only two rows are brought together.
    """

    def totals(df: DataFrame, side: str) -> DataFrame:
        digest = _digest(df.columns) if content else F.lit(None).cast("decimal(38,0)")
        return df.agg(F.count("*").alias("n"), digest.alias("h")).withColumn("side", F.lit(side))

    both = totals(old, "old").unionByName(totals(new, "new"))
    pick = {f"{s}_{v}": F.max(F.when(F.col("side") == s, F.col(v))) for s in ("old", "new") for v in ("n", "h")}
    one = both.agg(*[c.alias(n) for n, c in pick.items()])
    equal = (F.col("old_n") == F.col("new_n")) & F.col("old_h").eqNullSafe(F.col("new_h"))
    return one.select(F.col("old_n").alias("old_rows"), F.col("new_n").alias("new_rows"), equal.alias("is_equal"))
