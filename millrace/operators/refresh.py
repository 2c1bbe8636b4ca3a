"""Refresh modes: which rows of a target a batch replaces.

Every mode is ``target minus hit rows, plus batch``. A mode only decides ``hit``; rows whose
column is NULL are never hit. The same :class:`Slice` drives the pure form
(:func:`refresh`) and the partitioned table commit (``plans.table``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from enum import Enum
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import join_groups

FILE_COLUMNS = ("FILENAME", "FILE_NAME")
PATH_COLUMN = "FILE_PATH"


class Mode(Enum):
    """The refresh and ingest modes by their configuration text."""

    FULL = "FULL"
    PARTITION = "PARTITION"
    PARTITION_MTD = "PARTITION_MTD"
    PARTITION_N_DAYS = "PARTITION_N_DAYS"
    CDC = "CDC"
    BACK_FILL_N_DAYS = "BACK_FILL_N_DAYS"
    MTD = "MTD"
    MASTERDATA = "MASTERDATA"
    SNAPSHOT = "SNAPSHOT"
    INCREMENTAL = "INCREMENTAL"


REFRESH_MODES = {Mode.FULL, Mode.PARTITION, Mode.PARTITION_MTD, Mode.PARTITION_N_DAYS}
INGEST_MODES = set(Mode) - REFRESH_MODES
REPLACE_ALL = {Mode.FULL, Mode.MASTERDATA}
MONTH_MODES = {Mode.PARTITION_MTD, Mode.MTD}
DAY_RANGE_MODES = {Mode.PARTITION_N_DAYS, Mode.BACK_FILL_N_DAYS}


def parse_mode(value: str | Mode | None) -> Mode | None:
    """Mode from its text; unknown text is an error."""
    return value if value is None or isinstance(value, Mode) else Mode(str(value).upper())


@dataclass(frozen=True)
class RefreshSpec:
    """What to replace: the mode and its parameters.

    ``refresh_type`` wins over ``ingest_type``; with neither, nothing is deleted. Files are told
    apart by path (``file_paths``, or FILE_PATH of the batch) where the target knows paths, else by name.
    """

    refresh_type: str | Mode | None = None
    ingest_type: str | Mode | None = None
    partition_column: str | None = None
    partition_value: str | date | datetime | None = None
    n_days: int | None = None
    file_names: str | Sequence[str] | None = None
    file_paths: Sequence[str] | None = None

    @property
    def mode(self) -> Mode | None:
        for value, allowed in ((self.refresh_type, REFRESH_MODES), (self.ingest_type, INGEST_MODES)):
            mode = parse_mode(value)
            if mode is not None:
                if mode not in allowed:
                    raise ValueError(f"{mode.value} is not valid here")
                return mode
        return None

    @property
    def replaces_all(self) -> bool:
        return self.mode in REPLACE_ALL

    @property
    def column(self) -> str:
        if not self.partition_column:
            raise ValueError(f"{self.mode.value} needs partition_column")
        return self.partition_column

    @property
    def value(self) -> datetime:
        if self.partition_value is None:
            raise ValueError(f"{self.mode.value} needs partition_value")
        return as_datetime(self.partition_value)


@dataclass(frozen=True)
class Slice:
    """Rows of a target that a refresh replaces.

    ``condition`` decides by value; ``names`` (distinct, one column ``name``) decides by join on each of
    ``name_columns`` and ``keys``. ``files`` are the names or paths that ``condition`` tests, if it is about files; ``by_path``
    says whether files are known by path. ``lower``/``upper`` bound the partition column, half-open, so that a
    partitioned table can prune. Nothing set means no row is hit.
    """

    everything: bool = False
    condition: Column | None = None
    names: DataFrame | None = None
    name_columns: tuple[str, ...] = ()
    keys: tuple[Column, ...] = ()
    files: tuple[str, ...] = ()
    by_path: bool = False
    lower: datetime | None = None
    upper: datetime | None = None

    @property
    def empty(self) -> bool:
        return not self.everything and self.condition is None and self.names is None

    def survivors(self, target: DataFrame) -> DataFrame:
        """Target rows that stay."""
        if self.everything:
            return target.where(F.lit(False))
        if self.condition is not None:
            return target.where(~F.coalesce(self.condition, F.lit(False)))
        if self.names is not None:
            for key in self._all_keys():
                target = self._joined(target, key, "left_anti")
        return target

    def _all_keys(self) -> list[Column]:
        return [*map(F.col, self.name_columns), *self.keys]

    def _joined(self, target: DataFrame, key: Column, how: str) -> DataFrame:
        keyed = target.withColumn("_file", key)
        return join_groups(keyed, self.names.withColumnRenamed("name", "_file"), ["_file"], how).drop("_file")

    def in_ledger(self, ledger: DataFrame) -> DataFrame | None:
        """Ledger entries of the files that are replaced; None if the slice is not about files."""
        file = F.col("file") if self.by_path else F.substring_index("file", "/", -1)
        if self.names is not None:
            return self._joined(ledger, file, "left_semi")
        return ledger.where(file.isin(list(self.files))) if self.files else None

    def hits(self, target: DataFrame) -> DataFrame:
        """Target rows that go."""
        if self.everything:
            return target
        if self.condition is not None:
            return target.where(self.condition)
        if self.names is not None:
            return reduce(DataFrame.unionAll, [self._joined(target, key, "left_semi") for key in self._all_keys()])
        return target.where(F.lit(False))


def as_datetime(value: str | date | datetime) -> datetime:
    """A day or time; ``yyyy-MM`` means the first of the month."""
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(f"{value}-01" if len(value) == 7 else value)


def month_range(value: str | date | datetime) -> tuple[datetime, datetime]:
    """Whole calendar month of ``value``, half-open."""
    day = as_datetime(value)
    first = datetime(day.year, day.month, 1)
    return first, datetime(day.year + day.month // 12, day.month % 12 + 1, 1)


def batch_days(batch: DataFrame, column: str) -> tuple[datetime, datetime] | None:
    """First day and the day after the last day in the batch: one aggregate, one row."""
    days = F.col(column).cast("date")
    low, high = batch.agg(F.min(days), F.max(days)).first()
    return None if low is None else (as_datetime(low), as_datetime(high) + timedelta(days=1))


def in_range(column: str, lower: datetime, upper: datetime) -> Column:
    """Half-open range test that the file scan can push down."""
    return (F.col(column) >= _literal(lower)) & (F.col(column) < _literal(upper))


def _literal(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def file_name_columns(columns: Sequence[str]) -> tuple[str, ...]:
    """Target columns that hold a file name, whatever their case."""
    return tuple(c for c in columns if c.upper() in FILE_COLUMNS)


def path_column(columns: Sequence[str]) -> str | None:
    return next((c for c in columns if c.upper() == PATH_COLUMN), None)


def file_keys(columns: Sequence[str]) -> list[Column]:
    """What tells the files of a table's rows apart: the path if there is one (the name where it is
    NULL), else each of the name columns.
    """
    names, path = file_name_columns(columns), path_column(columns)
    return [F.coalesce(path, *names)] if path else [F.col(c) for c in names]


def plain_path(path: str) -> str:
    """A path whose scheme is followed by one slash, as listings and readers write it differently."""
    return re.sub("^([a-z0-9]+):/+", r"\1:/", path)


def row_path(column: str = "_metadata.file_path") -> Column:
    """:func:`plain_path` of the file a row was read from; the reader's percent codes are undone."""
    decoded = F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^([a-z0-9]+):/+", "$1:/")


def _file_slice(spec: RefreshSpec, batch: DataFrame, target_columns: Sequence[str]) -> Slice:
    columns, keys = file_name_columns(target_columns), tuple(file_keys(target_columns))
    source = {c.upper(): c for c in batch.columns}
    named, placed = source.get("FILE_NAME"), source.get(PATH_COLUMN)
    if spec.file_paths and path_column(target_columns):
        paths = [plain_path(p) for p in spec.file_paths]
        files = (*paths, *dict.fromkeys(p.rsplit("/", 1)[-1] for p in paths))
        return Slice(condition=keys[0].isin(list(files)), files=files, by_path=True)
    given = [spec.file_names] if isinstance(spec.file_names, str) else list(spec.file_names or [])
    if given and columns:
        return Slice(condition=reduce(Column.__or__, [F.col(c).isin(given) for c in columns]), files=tuple(given))
    if placed and path_column(target_columns):
        both = F.array(placed, named) if named else F.array(placed)
        names = batch.select(F.explode(both).alias("name")).where(F.col("name").isNotNull()).distinct()
        return Slice(names=names, keys=keys, by_path=True)
    if not columns or named is None:
        return Slice()
    names = batch.select(F.col(named).alias("name")).where(F.col("name").isNotNull()).distinct()
    return Slice(names=names, name_columns=columns)


def resolve(spec: RefreshSpec, batch: DataFrame, target_columns: Sequence[str]) -> Slice:
    """The slice ``spec`` replaces in a target with these columns."""
    mode = spec.mode
    if mode in REPLACE_ALL:
        return Slice(everything=True)
    if mode is Mode.CDC:
        return _file_slice(spec, batch, target_columns)
    if mode is Mode.PARTITION:
        value = spec.partition_value
        if value is None:
            raise ValueError("PARTITION needs partition_value")
        try:
            moment = as_datetime(value)
        except (TypeError, ValueError):
            return Slice(condition=F.col(spec.column) == F.lit(value))
        point = _literal(moment) if isinstance(value, (date, datetime)) else F.lit(value)
        return Slice(
            condition=F.col(spec.column) == point, lower=moment, upper=moment + timedelta(microseconds=1)
        )
    if mode in MONTH_MODES:
        lower, upper = month_range(spec.value)
    elif mode in DAY_RANGE_MODES and spec.n_days:
        start = spec.value
        lower = start - timedelta(days=spec.n_days)
        upper = start + timedelta(days=1)
    elif mode in DAY_RANGE_MODES:
        bounds = batch_days(batch, spec.column)
        if bounds is None:
            return Slice()
        lower, upper = bounds
    else:
        return Slice()
    return Slice(condition=in_range(spec.column, lower, upper), lower=lower, upper=upper)


def refresh(target: DataFrame, batch: DataFrame, spec: RefreshSpec) -> DataFrame:
    """The target after the refresh, as a lazy DataFrame. Batch columns match by name."""
    if spec.replaces_all:
        return batch
    kept = resolve(spec, batch, target.columns).survivors(target)
    return kept.unionByName(batch, allowMissingColumns=True)


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Rows that do not satisfy ``condition``; NULL counts as not satisfied."""
    return target.where(~F.coalesce(condition, F.lit(False)))


def upsert(
    target: DataFrame, records: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Insert or update by key. Of several records with one key, the greatest ``order`` wins;
    without ``order`` different records of one key are an error.
    """
    from millrace.operators.changes import latest_per_key, one_per_key

    last = latest_per_key(records, keys, order) if order else one_per_key(records, keys)
    kept = join_groups(target, last.select(*keys), list(keys), "left_anti")
    return kept.unionByName(last.select(target.columns))
