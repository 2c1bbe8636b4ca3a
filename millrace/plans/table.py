"""Warehouse tables: parquet partitioned by a derived slice, refreshed slice by slice.

``SCHEMA.TABLE`` is a view on one numbered *version*, an external table in the database
``SCHEMA__versions``. Its partition column stays a normal column; the first day of its month (or
day, week, year) is the directory key SLICE_START. A slice refresh rewrites only the affected slices
in one dynamic overwrite, which Spark stages and commits at the end. A full refresh writes the next
version and then replaces the view, one statement of the catalog: at any moment the name stands for
one whole version. The view's properties name its version, so versions of runs that died are never
taken for the table; the next writer drops them. Readers change nothing.
One writer per table at a time; re-running a failed refresh repairs it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace as with_values
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.calendar import slice_interval, slice_start, slice_start_of
from millrace.operators.joins import join_groups
from millrace.operators.reconcile import content_mismatch, reconcile_totals
from millrace.operators.refresh import RefreshSpec, Slice, file_keys, resolve
from millrace.operators.schema import add_missing_columns, fit, order_columns, require_width, sync_types
from millrace.plans.keys import KeySketches
from millrace.plans.ledger import FileLedger, entries
from millrace.session import delete_path, scratch_dir
from millrace.sources.catalog import split_name, table_exists

SLICE = "SLICE_START"
ROWS_PER_FILE = 1048576  # fixed value: rows of one output file


def ensure_database(spark: SparkSession, name: str, location: str) -> None:
    """Create the database at ``location`` unless it exists."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


class WarehouseTable:
    """The only writer of a table. Reading gives the table without its slice key."""

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        partition_column: str | None = None,
        interval: str = "MONTHLY",
        text_limit: int | None = None,
    ) -> None:
        """``text_limit`` makes every write fail on a longer text; the table remembers it."""
        self.spark = spark
        self.name = name
        self.database, self.table = split_name(name)
        self.partition_column = None if partition_column == "None" else partition_column
        self.interval = slice_interval(interval)
        self.text_limit = text_limit
        if self.exists:
            stored = self._properties(self.stored)
            self.partition_column = stored.get("millrace.partition_column")
            self.interval = stored.get("millrace.interval", interval)
            self.text_limit = int(stored["millrace.text_limit"]) if "millrace.text_limit" in stored else text_limit

    # metadata and versions

    @property
    def exists(self) -> bool:
        return table_exists(self.spark, self.name)

    @property
    def stored(self) -> str:
        """The table that holds the rows now."""
        number = self._properties(self.name).get("millrace.version")
        if number is None:
            raise ValueError(f"{self.name} is not a table made by this library")
        return self._version_name(int(number))

    def _version_name(self, number: int) -> str:
        return f"{self.database}__versions.{self.table}__v{number}".lower()

    def _versions(self) -> list[int]:
        """Numbers of all versions, ascending: the current one, and what dead runs left behind."""
        if not self.spark.catalog.databaseExists(f"{self.database}__versions"):
            return []
        head = f"{self.table}__v".lower()
        rows = self.spark.sql(f"SHOW TABLES IN {self.database}__versions LIKE '{head}*'").collect()
        tails = [r["tableName"].removeprefix(head) for r in rows if not r["isTemporary"]]
        return sorted(int(t) for t in tails if t.isdigit())

    def _next_version(self) -> str:
        return self._version_name(max(self._versions(), default=0) + 1)

    def _run(self, statement: str) -> None:
        """One change of the catalog."""
        self.spark.sql(statement)

    def _point(self, version: str) -> None:
        """Make ``version`` the table, in one statement."""
        number = version.rsplit("__v", 1)[1]
        self._run(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('millrace.version' = '{number}') AS SELECT * FROM {version}")

    def _drop_version(self, version: str) -> None:
        """The files go first: a run that dies in between leaves a name that can be dropped again."""
        where = self._location(version)
        for path in (where, self._ledger_folder(where), f"{where}.keys"):
            delete_path(self.spark, path)
        self._run(f"DROP TABLE {version}")

    @staticmethod
    def _ledger_folder(location: str) -> str:
        return f"{location}.files"

    def _ledger(self, version: str | None = None) -> FileLedger:
        return FileLedger(self.spark, self._ledger_folder(self._location(version)))

    def files(self) -> DataFrame:
        """``file``, ``slice`` and ``rows`` of all files that the table has rows of, without reading rows."""
        return self._known_files().read().groupBy("file", "slice").agg(F.sum("rows").alias("rows"))

    def _known_files(self) -> FileLedger:
        """The ledger; one that is missing is made from the rows first."""
        ledger = self._ledger()
        if not ledger.exists and file_keys(self._rows().columns):
            ledger.rewrite(self._entries(self._rows()))
        return ledger

    def _entries(self, rows: DataFrame) -> DataFrame:
        return entries(rows, SLICE if self.partition_column else None)

    def _announce(self, rows: DataFrame) -> None:
        """Enter the files of rows that are about to be written."""
        if file_keys(rows.columns):
            self._known_files().add(self._entries(rows))

    def _settle(self, slices: set[date | None]) -> None:
        """Enter again what rewritten slices hold now."""
        if slices and file_keys(self._rows().columns):
            within = self._slice_in(slices)
            held = self._entries(self._rows().where(within))
            ledger = self._ledger()
            ledger.rewrite(ledger.without(self._slice_in(slices, "slice")).unionByName(held))

    def _clean(self) -> None:
        """Drop all versions but the current one."""
        current = self.stored if self.exists else None
        for name in map(self._version_name, self._versions()):
            if name != current:
                self._drop_version(name)

    def _properties(self, name: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
        return {r["key"]: r["value"] for r in rows}

    def _location(self, name: str | None = None) -> str:
        name = self.stored if name in (None, self.name) else name
        rows = self.spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").collect()
        return rows[-1]["data_type"]

    @property
    def schema(self) -> T.StructType:
        """Columns without the slice key; NOT NULL columns are kept as a table property."""
        stored = self.stored
        required = set(filter(None, self._properties(stored).get("millrace.not_null", "").split(",")))
        fields = self.spark.table(stored).schema.fields
        return T.StructType(
            [T.StructField(f.name, f.dataType, f.name not in required) for f in fields if f.name != SLICE]
        )

    def slices(self) -> list[date | None]:
        """Slices present, from the catalog; no data is read."""
        if not self.partition_column:
            return []
        names = [r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {self.stored}").collect()]
        return [None if n.startswith("__HIVE") or n == "null" else date.fromisoformat(n) for n in names]

    # reading

    def read(self) -> DataFrame:
        return self._rows().drop(SLICE)

    def _rows(self) -> DataFrame:
        return self.spark.table(self.stored)

    def scan(self, lower=None, upper=None) -> DataFrame:
        """Rows with the partition column in ``[lower, upper)``, pruned to their slices."""
        from millrace.operators.refresh import as_datetime, in_range

        lower, upper = as_datetime(lower), as_datetime(upper)
        return self._rows().where(self._within(lower, upper) & in_range(self.partition_column, lower, upper)).drop(SLICE)

    def _within(self, lower, upper) -> Column:
        first = slice_start_of(lower, self.interval)
        last = slice_start_of(upper - timedelta(microseconds=1), self.interval)
        return F.col(SLICE).between(F.lit(first), F.lit(last))

    # writing

    def create(self, schema: T.StructType) -> None:
        """Empty table of ``schema``."""
        if self.exists:
            raise ValueError(f"{self.name} exists")
        self._clean()
        self._point(self._create_version(schema))

    def _create_version(self, schema: T.StructType) -> str:
        """The next version, empty, in a location of its own; nobody sees it yet."""
        base = self.spark.catalog.getDatabase(self.database).locationUri.rstrip("/")
        ensure_database(self.spark, f"{self.database}__versions", f"{base}/__versions")
        name = self._next_version()
        where = f"{base}/{self.table}/{uuid.uuid4().hex}"
        required = ",".join(f.name for f in schema.fields if not f.nullable)
        columns, partitioned, properties = _ddl(schema), "", {"millrace.not_null": required}
        if self.partition_column:
            columns += f", `{SLICE}` date"
            partitioned = f"PARTITIONED BY (`{SLICE}`)"
            properties |= {
                "millrace.partition_column": self.partition_column,
                "millrace.interval": self.interval,
            }
        if self.text_limit is not None:
            properties["millrace.text_limit"] = str(self.text_limit)
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        self._run(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic', maxRecordsPerFile '{ROWS_PER_FILE}') "
            f"{partitioned} LOCATION '{where}' TBLPROPERTIES ({listed})"
        )
        return name

    def _sliced(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        """``df`` in table columns plus the slice key."""
        fitted = fit(df, schema)
        if self.text_limit is not None:
            fitted = require_width(fitted, self.text_limit)
        if not self.partition_column:
            return fitted
        return fitted.withColumn(SLICE, slice_start(self.partition_column, self.interval))

    def _insert(self, rows: DataFrame, name: str, overwrite: bool = False, spread: bool = True) -> int:
        """Write sliced rows; returns their number.

        Rows of many slices are rebalanced by slice first: without it every task would open a
        file in every slice. The rebalance merges small slices into one task and splits a
        slice too big for one. Rows of one slice, or of an unsliced table, need no shuffle.
        """
        counted = Observation()
        if self.partition_column and spread:
            rows = rows.hint("rebalance", F.col(SLICE))
        # Counted behind the shuffle: AQE drops the plan of an empty shuffle, and a count in it would be lost.
        rows = rows.observe(counted, F.count(F.lit(1)).alias("n"))
        rows.write.mode("overwrite" if overwrite else "append").insertInto(name)
        return counted.get["n"]

    def append(self, df: DataFrame, clustered: bool = False) -> int:
        """Add rows; nothing is deleted. Creates the table if it is missing.

        ``clustered`` says that the input is already ordered by the partition column, so that
        every task sees few slices and the shuffle can be left out.
        """
        if not self.exists:
            self.create(df.schema)
        if file_keys(self.schema.fieldNames()):
            return self._with_stage(df, False, lambda rows: self._append(rows, clustered))
        return self._append(df, clustered)

    def _append(self, df: DataFrame, clustered: bool = False) -> int:
        rows = self._sliced(df, self.schema)
        self._announce(rows)
        return self._insert(rows, self.stored, spread=not clustered)

    def replace(self, df: DataFrame) -> int:
        """Full refresh: the table gets the rows and the schema of ``df``."""
        return self._new_version(self._sliced(df, df.schema), df.schema)

    def _new_version(self, rows: DataFrame, schema: T.StructType) -> int:
        """Write the next version, switch to it, drop the others."""
        self._clean()
        name = self._create_version(schema)
        n = self._insert(rows, name)
        written = self.spark.table(name)
        if file_keys(written.columns):
            self._ledger(name).rewrite(self._entries(written))
        self._point(name)
        self._clean()
        return n

    def swap_with(self, new: WarehouseTable, content: bool = False) -> bool:
        """Put ``new`` in this table's place if their row counts (and content) agree.

        ``new`` hands its version over and is no table afterwards. A run that dies on the way leaves
        this table as it was.
        """
        verdict = reconcile_totals(self.read(), new.read(), content).first()
        if not verdict["is_equal"]:
            return False
        self._clean()
        theirs, mine = new.stored, self._next_version()
        self._run(f"DROP VIEW {new.name}")
        self._run(f"ALTER TABLE {theirs} RENAME TO {mine}")
        self._point(mine)
        self._clean()
        self.partition_column, self.interval = new.partition_column, new.interval
        return True

    def add_columns(self, fields: Sequence[T.StructField]) -> None:
        """Schema evolution: old files give NULL for the new columns."""
        if fields:
            self._run(f"ALTER TABLE {self.stored} ADD COLUMNS ({_ddl(T.StructType(list(fields)))})")
        if self.spark.table(self.name).columns != self._rows().columns:
            self._point(self.stored)  # a view keeps the columns it was made with

    def refresh(self, batch: DataFrame, spec: RefreshSpec, staged: bool = False) -> int:
        """Replace the slice ``spec`` names by ``batch``; returns the batch rows written.

        A batch that is costly to compute or read is staged first (unless the caller already
        has), since bounds, affected slices and the write each pass over it.
        """
        if not self.exists:
            return self.append(batch)
        if spec.replaces_all:
            return self.replace(batch)
        if spec.mode is None:
            return self.append(batch)
        if spec.partition_column is None and self.partition_column:
            spec = with_values(spec, partition_column=self.partition_column)
        batch = self._aligned(batch)
        return self._with_stage(batch, staged, lambda b: self._refresh(b, spec))

    def _aligned(self, batch: DataFrame) -> DataFrame:
        """Sink types and missing columns; extra columns (a file name, say) stay."""
        schema = self.schema
        return order_columns(sync_types(add_missing_columns(batch, schema), schema), schema)

    def _with_stage(self, batch: DataFrame, staged: bool, work: Callable[[DataFrame], int]) -> int:
        if staged:
            return work(batch)
        path = scratch_dir(self.spark, f"batch-{self.table}")
        batch.write.parquet(path)
        try:
            return work(self.spark.read.schema(batch.schema).parquet(path))
        finally:
            delete_path(self.spark, path)

    def _refresh(self, batch: DataFrame, spec: RefreshSpec) -> int:
        columns = self.schema.fieldNames()
        hit = resolve(spec, batch, columns)
        if hit.empty:
            return self._append(batch)
        if (spec.partition_column or "").lower() != (self.partition_column or "").lower():
            hit = with_values(hit, lower=None, upper=None)
        return self._rewrite(hit, batch)

    def _rewrite(self, hit: Slice, batch: DataFrame) -> int:
        schema = self.schema
        about_files = hit.files or hit.names is not None
        known = hit.in_ledger(self._known_files().read()) if about_files else None
        if known is not None and known.isEmpty():
            return self._append(batch)
        if not self.partition_column:
            rows = fit(batch, schema)
            self._replace_keeping_schema(hit.survivors(self.read()).unionByName(rows), schema)
            return rows.count()
        present = self.slices()
        if hit.lower is not None and (hit.condition is not None):
            first = slice_start_of(hit.lower, self.interval)
            last = slice_start_of(hit.upper - timedelta(microseconds=1), self.interval)
            touched = {s for s in present if s is not None and first <= s <= last}
        elif known is not None:
            touched = {r["slice"] for r in known.select("slice").distinct().collect()}
        else:
            touched = self._slices_of(hit.hits(self._rows()))
        return self._overwrite(touched, hit.survivors, batch, schema, present)

    def _replace_keeping_schema(self, rows: DataFrame, schema: T.StructType) -> None:
        self._new_version(rows.select(schema.fieldNames()), schema)

    @staticmethod
    def _slices_of(rows: DataFrame) -> set[date | None]:
        """Slices that occur in ``rows``: as many values as directories at most."""
        return {r[0] for r in rows.select(SLICE).distinct().collect()}

    @staticmethod
    def _in(value: Column, slices: set[date | None]) -> Column:
        known = [F.lit(s) for s in slices if s is not None]
        test = value.isin(known) if known else F.lit(False)
        return test | value.isNull() if None in slices else test

    @classmethod
    def _slice_in(cls, slices: set[date | None], column: str = SLICE) -> Column:
        return cls._in(F.col(column), slices)

    def _overwrite(
        self,
        touched: set[date | None],
        survivors: Callable[[DataFrame], DataFrame],
        batch: DataFrame,
        schema: T.StructType,
        present: Sequence[date | None],
    ) -> int:
        """Rewrite the touched slices in one commit, then append the rows of all others.

        Slices that lose nothing keep their files. The append comes last: a run that dies before
        it is repeated whole, and finds the touched slices as it would have left them.
        """
        rows = self._sliced(batch, schema)
        incoming = self._slices_of(rows)
        stored = self.stored
        target = self.spark.table(stored)
        listed, touched = touched, touched & set(present)
        bare = touched - incoming
        kept = self._slices_of(survivors(target.where(self._slice_in(bare)))) if bare else set()
        new = incoming - touched
        self._announce(rows)
        if (touched & incoming) or kept:
            stay = survivors(target.where(self._slice_in(touched)))
            whole = stay.unionByName(rows.where(self._slice_in(touched)) if new else rows)
            self._insert(whole.select(target.columns), stored, overwrite=True, spread=len(touched) > 1)
        for emptied in bare - kept:
            self._drop_slice(emptied)
        if new:
            rest = rows.where(self._slice_in(new)) if touched else rows
            self._insert(rest.select(target.columns), stored, spread=len(new) > 1)
        self._settle(listed | incoming)
        return batch.count()

    def refresh_slices(self, batch: DataFrame, due: Sequence[date] = ()) -> int:
        """Replace every slice that occurs in the batch: many months in one job, no target read.

        ``due`` names slices to replace even if the batch has no row for them.
        """
        if not self.exists:
            return self.append(batch)
        if not due and not file_keys(self.schema.fieldNames()):
            return self._insert(self._sliced(batch, self.schema), self.stored, overwrite=True)

        def work(rows: DataFrame) -> int:
            sliced = self._sliced(rows, self.schema)
            self._announce(sliced)
            wanted = {slice_start_of(_midnight(d), self.interval) for d in due}
            filled = self._slices_of(sliced)
            bare = (wanted & set(self.slices())) - filled
            n = self._insert(sliced, self.stored, overwrite=True)
            for emptied in bare:
                self._drop_slice(emptied)
            self._settle(bare | filled)
            return n

        return self._with_stage(self._aligned(batch), False, work)

    def delete(self, condition: Column) -> None:
        """Delete by predicate: rewrites the slices with hits and drops those left empty."""
        hit = Slice(condition=condition)
        nothing = self.spark.createDataFrame([], self.schema)
        self._rewrite(hit, nothing)

    def upsert(self, records: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> int:
        """Insert or update by key; rewrites only slices that hold one of the keys.

        Of several records with one key the greatest ``order`` wins; without it they must be equal.
        """
        from millrace.operators.changes import latest_per_key, one_per_key

        last = latest_per_key(records, keys, order) if order else one_per_key(records, keys)
        if not self.exists:
            return self.append(last)

        def work(rows: DataFrame) -> int:
            chosen = rows.select(*keys)

            def survivors(df: DataFrame) -> DataFrame:
                return join_groups(df, chosen, keys, "left_anti")

            schema = self.schema
            if not self.partition_column:
                self._replace_keeping_schema(survivors(self.read()).unionByName(fit(rows, schema)), schema)
                return rows.count()
            touched = self._slices_with(chosen, keys)
            return self._overwrite(touched, survivors, rows, schema, self.slices())

        return self._with_stage(last, False, work)

    def _slices_with(self, chosen: DataFrame, keys: Sequence[str]) -> set[date | None]:
        """Slices that may hold one of the keys, from the sketches of the files where these help."""
        rows = self._rows()
        found = KeySketches(self.spark, f"{self._location()}.keys", keys, SLICE).slices(rows, chosen)
        return self._slices_of(join_groups(rows, chosen, keys, "left_semi")) if found is None else found

    def purge(self, day: date | None) -> None:
        """Drop one slice and its files."""
        self._drop_slice(day)
        self._settle({None if day is None else slice_start_of(_midnight(day), self.interval)})

    def _drop_slice(self, day: date | None) -> None:
        if day is None:
            return self._purge_null()
        start = slice_start_of(_midnight(day), self.interval)
        where = f"{self._location()}/{SLICE}={start.isoformat()}"
        self.spark.sql(f"ALTER TABLE {self.stored} DROP IF EXISTS PARTITION ({SLICE} = DATE'{start}')")
        delete_path(self.spark, where)

    def _purge_null(self) -> None:
        where = f"{self._location()}/{SLICE}=__HIVE_DEFAULT_PARTITION__"
        self.spark.sql(f"ALTER TABLE {self.stored} DROP IF EXISTS PARTITION ({SLICE} = NULL)")
        delete_path(self.spark, where)

    def repartition(self, column: str, interval: str = "MONTHLY") -> bool:
        """Rebuild the table partitioned by ``column``, check counts and content, swap.

        After an interruption only the slices whose content differs are written again, also where their
        row counts are equal. What was begun for another schema or slicing is begun anew.
        """
        new = WarehouseTable(self.spark, f"{self.name}_TEMP", column, interval)
        source, schema = self.read(), self.schema
        if new.exists and (new.schema, new.partition_column, new.interval) != (schema, column, slice_interval(interval)):
            new = new._begun_anew(schema, column, interval)
        if not new.exists:
            new.create(schema)
            new.append(source)
        else:
            start = slice_start(column, new.interval)
            wrong = {r["part"] for r in content_mismatch(source, new.read(), start).select("part").collect()}
            if wrong:
                chosen = source.where(self._in(start, wrong))
                lost = None in wrong and chosen.where(F.col(column).isNull()).isEmpty()
                new.refresh_slices(chosen, due=sorted(day for day in wrong if day is not None))
                if lost:
                    new.purge(None)
        return self.swap_with(new, content=True)

    def _begun_anew(self, schema: T.StructType, column: str, interval: str) -> WarehouseTable:
        """This table, empty, with another schema and other slices."""
        self.partition_column, self.interval = column, slice_interval(interval)
        empty = self.spark.createDataFrame([], schema)
        self._new_version(self._sliced(empty, schema), schema)
        return self


def _midnight(day: date):
    from datetime import datetime

    return datetime(day.year, day.month, day.day)
