"""Change detection: new files, changed content, latest versions, SCD type 2."""

from __future__ import annotations

import fnmatch
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.functions.text import stem, suffix
from millrace.operators.joins import join_groups

FILES_PER_RUN = 20  # fixed value: cap of one incremental run


def _version(col: str = "last_modified_dt") -> Column:
    """File time cut to the second, the precision of the file log."""
    return F.date_trunc("second", F.col(col))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row of every key, by the ``order`` columns descending.

    An aggregate with partial results per task, so one hot key never lands in a task whole.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest)
    best = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row"))
    return best.select(*keys, "_row.*").select(df.columns)


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows; fails when it runs if one key has rows that differ."""
    rest = [c for c in df.columns if c not in keys]
    row = F.any_value(F.struct(*rest)) if rest else F.any_value(F.struct(F.lit(1)))
    checked = F.when(F.count("*") > 1, F.raise_error(F.lit("several records of one key, and no order"))).otherwise(row)
    best = df.distinct().groupBy(*keys).agg(checked.alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(df.columns)


def newest_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The ``n`` newest rows of every key; ``order`` must tell rows apart.

    Spark limits each group inside every task before the shuffle, so hot keys stay small.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def retention_expired(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 2
) -> DataFrame:
    """Everything older than the ``n`` newest rows of its key.

    The oldest kept row of each key is a cut-off (at most ``n`` rows per key are ranked);
    rows below it are expired. No group is ever sorted whole.
    """
    marks = F.struct(*order)
    cutoff = (
        newest_n(df, keys, order, n)
        .groupBy(*keys)
        .agg(F.min(marks).alias("_cutoff"), F.count("*").alias("_kept"))
        .where(F.col("_kept") >= n)
        .select(*keys, "_cutoff")
    )
    joined = join_groups(df, cutoff, keys, "inner", null_group=True)
    return joined.where(marks < F.col("_cutoff")).select(df.columns)


def latest_by_pattern(listing: DataFrame, patterns: Sequence[str], name: str = "filename") -> DataFrame:
    """Greatest file name of every glob pattern: one aggregate over the listing."""
    picks = [
        F.max(F.when(F.col(name).rlike(fnmatch.translate(p)), F.col(name))).alias(f"p{i}")
        for i, p in enumerate(patterns)
    ]
    wide = listing.agg(*picks)
    pairs = F.array(
        *[F.struct(F.lit(p).alias("pattern"), F.col(f"p{i}").alias("filename")) for i, p in enumerate(patterns)]
    )
    return wide.select(F.inline(pairs)).where(F.col("filename").isNotNull())


def imported_names(sink: DataFrame) -> DataFrame:
    """Distinct file names already in a sink, from FILENAME and FILE_NAME."""
    from millrace.operators.refresh import file_name_columns

    columns = file_name_columns(sink.columns)
    if not columns:
        return sink.select(F.lit(None).cast("string").alias("filename")).where(F.lit(False))
    parts = [sink.select(F.col(c).alias("filename")) for c in columns]
    return reduce(DataFrame.unionAll, parts).where(F.col("filename").isNotNull()).distinct()


def unlogged(listing: DataFrame, log: DataFrame) -> DataFrame:
    """Listed files whose (parent, name, time) is not in the log."""
    logged = log.select(
        F.col("parent_path").alias("_parent"), F.col("filename").alias("_name"), _version().alias("_time")
    )
    same = (
        (F.col("parent_path") == F.col("_parent"))
        & (F.col("filename") == F.col("_name"))
        & (_version() == F.col("_time"))
    )
    return listing.join(logged, same, "left_anti")


def new_files(
    listing: DataFrame,
    log: DataFrame,
    imported: DataFrame | None = None,
    pattern: str | None = None,
    masterdata: bool = False,
    force_rerun: bool = False,
    reload_modified: bool = False,
) -> DataFrame:
    """Files to load: not in the log, and not imported before.

    ``imported`` has the names (``filename``) of files in the sink; where it has their paths too
    (``file_path``), these decide, so that equal names in two folders are two files.

    ``pattern`` is a regular expression found anywhere in the name.
    ``masterdata`` keeps only the newest name above everything imported. ``force_rerun``
    forgets the log rows whose name starts with the pattern. ``reload_modified`` also loads
    a file that changed but kept an imported name.
    """
    if pattern:
        listing = listing.where(F.col("filename").rlike(pattern) & F.col("st_size").isNotNull())
        log = log.where(F.col("filename").rlike(pattern))
        if force_rerun:
            log = log.where(~F.startswith(F.col("filename"), F.lit(pattern)))
            if imported is not None:
                imported = imported.where(F.col("filename") != pattern)
    fresh = unlogged(listing, log)
    full_path = F.concat_ws("/", "parent_path", "filename")
    if masterdata:
        newest = listing.agg(F.max("filename")).scalar()
        if imported is None:
            pick = F.col("filename") == newest
        else:
            top = imported.agg(F.max("filename")).scalar()
            pick = F.when(top.isNull(), F.col("filename") == newest).otherwise(F.col("filename") > top)
        best = fresh.where(pick).orderBy(F.desc("filename"), F.desc("last_modified_dt")).limit(1)
        return best.withColumn("full_path", full_path)
    if imported is not None and not reload_modified:
        placed = "file_path" in imported.columns
        names = imported.where("file_path IS NULL") if placed else imported
        fresh = join_groups(fresh, names.select("filename").distinct() if placed else names.select("filename"), ["filename"], "left_anti")
        if placed:
            paths = imported.select(F.col("file_path").alias("_path")).where("_path IS NOT NULL").distinct()
            fresh = join_groups(fresh.withColumn("_path", plain(full_path)), paths, ["_path"], "left_anti").drop("_path")
    return fresh.withColumn("full_path", full_path)


def plain(path: Column) -> Column:
    """A path whose scheme is followed by one slash."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def cap_files(files: DataFrame, n: int | None = None, newest_only: bool = False) -> DataFrame:
    """Files of one run: all, the ``n`` lowest paths, or only the greatest for month refreshes."""
    if newest_only:
        return files.orderBy(F.desc("full_path")).limit(1)
    if n is None:
        return files
    return files.orderBy("full_path").limit(n)


def changed_content(
    current: DataFrame,
    log: DataFrame,
    key: str = "file_name",
    content_hash: str = "hash_check_sum",
    order: Sequence[str] = ("st_mtime",),
) -> DataFrame:
    """``current`` with ``is_changed``: the hash differs from the newest logged one, or none is logged."""
    last = latest_per_key(log.select(key, content_hash, *order), [key], list(order))
    joined = join_groups(current, last.select(key, F.col(content_hash).alias("_hash")), [key])
    return joined.withColumn("is_changed", ~F.col(content_hash).eqNullSafe(F.col("_hash"))).drop("_hash")


def copy_plan(
    source: DataFrame,
    sink: DataFrame,
    group: str,
    target_pattern: Column | str,
    run_date: str,
    force: bool = False,
) -> DataFrame:
    """Newest file per group on both sides, and whether to copy it.

    A target pattern with ``*`` gets the run date: ``<stem>_<yyyyMMdd><suffix>``.
    """
    newest = [latest_per_key(df.select(group, "filename", "content_hash"), [group], ["filename"]) for df in (source, sink)]
    last_sink = newest[1].select(group, F.col("content_hash").alias("_hash"))
    joined = join_groups(newest[0], last_sink, [group], null_group=True)
    pattern = F.lit(target_pattern) if isinstance(target_pattern, str) else target_pattern
    base = F.regexp_replace(F.regexp_replace(stem(pattern), r"\*$", ""), "_$", "")
    ext = F.when(suffix(pattern) != "", F.concat(F.lit("."), suffix(pattern))).otherwise("")
    dated = F.concat(base, F.lit("_" + run_date.replace("-", "")), ext)
    differs = ~F.col("content_hash").eqNullSafe(F.col("_hash"))
    return joined.select(
        group,
        F.col("filename").alias("source_file"),
        F.when(F.contains(pattern, F.lit("*")), dated).otherwise(pattern).alias("target_file"),
        F.when(differs | F.lit(force), "copy").otherwise("skip").alias("action"),
    )


def _changed(tracked: Sequence[str], old: str, new: str) -> Column:
    tests = [~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in tracked]
    return reduce(Column.__or__, tests)


def _match(current: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key (NULL is a key) with the row of either side as structs ``c`` and ``n``.

    Both sides are stacked and aggregated by key, in every task before the shuffle: repeated
    keys do not multiply, and a hot key is small when it moves. Of several rows of one key on
    one side the greatest counts.
    """
    c, n = F.struct(*current.columns), F.struct(*new.columns)
    names = [f"_k{i}" for i in range(len(keys))]
    own = [F.col(k).alias(name) for k, name in zip(keys, names)]
    left = current.select(*own, c.alias("c"), F.lit(None).cast(new.select(n).schema[0].dataType).alias("n"))
    right = new.select(*own, F.lit(None).cast(current.select(c).schema[0].dataType).alias("c"), n.alias("n"))
    return left.unionByName(right).groupBy(*names).agg(F.max("c").alias("c"), F.max("n").alias("n")).select("c", "n")


def scd2_delta(
    current: DataFrame, new: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Keys, new tracked values and ``change_type``: insert, update or expire."""
    kind = (
        F.when(F.col("c").isNull(), "insert")
        .when(F.col("n").isNull(), "expire")
        .when(_changed(tracked, "c", "n"), "update")
    )
    return (
        _match(current.select(*keys, *tracked), new.select(*keys, *tracked), keys)
        .withColumn("change_type", kind)
        .where(F.col("change_type").isNotNull())
        .select(
            *[F.coalesce(f"n.{k}", f"c.{k}").alias(k) for k in keys],
            *[F.col(f"n.{c}").alias(c) for c in tracked],
            "change_type",
        )
    )


def scd2_start(df: DataFrame, since: str) -> DataFrame:
    """First version of a dimension: every row open since ``since``."""
    return df.withColumns(
        {
            "valid_from": F.lit(since).cast("timestamp_ntz"),
            "valid_to": F.lit(None).cast("timestamp_ntz"),
            "is_current": F.lit(True),
        }
    )


def scd2_dimension(
    dimension: DataFrame, new: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: str
) -> DataFrame:
    """Dimension after a load: changed and expired rows closed at ``as_of``, new versions opened.

    Open rows meet the new rows in one join; closed history passes by untouched.
    """
    moment = F.lit(as_of).cast("timestamp_ntz")
    never = F.lit(None).cast("timestamp_ntz")
    columns = [*keys, *tracked]
    opened_now = dimension.where("is_current").select(*columns, "valid_from")
    closed = dimension.where("NOT is_current").select(*columns, "valid_from", "valid_to", "is_current")

    def version(side: str, since: Column, until: Column, is_open: bool) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in columns],
            since.alias("valid_from"),
            until.alias("valid_to"),
            F.lit(is_open).alias("is_current"),
        )

    kept = version("c", F.col("c.valid_from"), never, True)
    ended = version("c", F.col("c.valid_from"), moment, False)
    started = version("n", moment, never, True)
    versions = (
        F.when(F.col("c").isNull(), F.array(started))
        .when(F.col("n").isNull(), F.array(ended))
        .when(_changed(tracked, "c", "n"), F.array(ended, started))
        .otherwise(F.array(kept))
    )
    live = _match(opened_now, new.select(*columns), keys).select(F.inline(versions))
    return closed.unionByName(live)
