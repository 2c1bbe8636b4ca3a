"""Parquet and delimited files."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.refresh import plain_path, row_path
from millrace.operators.relational import union_by_name
from millrace.session import stage, unstage
from millrace.sources.lines import encodings
from millrace.sources.listing import with_encoding
from millrace.sources.quoted import read_quoted, splittable
from millrace.sources.streams import head_of

TEXT_DELIMITER = "|"  # fixed value: delimiter of text files unless given


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parquet files; globs such as ``2018-??-??/*.parquet`` work. Columns of all files are merged."""
    return spark.read.option("mergeSchema", True).parquet(*([paths] if isinstance(paths, str) else paths))


def file_heads(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """Encoding and first line of every file under ``paths`` (files, folders or globs).

    Files are read inside the tasks, to their first line break. ``auto`` detects encodings from all
    bytes, in splits.
    """

    def heads(batches):
        for batch in batches:
            yield batch.assign(line=[head_of(*file) for file in zip(batch["path"], batch["encoding"])])

    listed = spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else list(paths)).select("path")
    if encoding == "auto":
        listed = with_encoding(listed, "path", encodings(spark, paths))
    else:
        listed = listed.withColumn("encoding", F.lit(encoding))
    return listed.mapInPandas(heads, "path string, encoding string, line string")


def choose_delimiter(line: str, given: str, default: str = TEXT_DELIMITER, fallback: str = ",") -> str:
    """``given`` unless it does not split the line; then the default, then a comma."""
    candidates = [given, default, fallback]
    return next((d for d in candidates if d in line), given)


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    delimiter: str = TEXT_DELIMITER,
    quote: str = "",
    encoding: str = "UTF-8",
    auto_delimiter: bool = False,
    schema: T.StructType | str | None = None,
    all_text: bool = False,
    infer_looks: bool = False,
    multi_line: bool | None = None,
    with_file_name: bool = False,
    with_path: bool = False,
) -> DataFrame:
    """Delimited text with a header. Quoting is off unless a quote character is given.

    Types come from ``schema``, from Spark's inference, from the looks of all values with
    ``infer_looks``, or stay text with ``all_text``. Line breaks inside quotes are allowed once a
    quote character is given: UTF-8 files are still read in splits, see ``sources.quoted``; with
    ``multi_line`` each file is read by one task, without it (False) no value may hold a line break.

    Paths may be files, folders or globs. Files that differ in header or encoding are read by
    groups and united by column name, each with the delimiter that fits its header. With a
    ``schema`` columns go by position, so all files must have it.
    """
    groups = header_groups(spark, path, encoding)
    if schema is not None and len({line for _, line, _ in groups}) > 1:
        raise ValueError("files with different headers cannot share one schema by position")

    def read(found: str, line: str, files: Sequence[str]) -> DataFrame:
        mark = choose_delimiter(line, delimiter) if auto_delimiter else delimiter
        if quote and multi_line is None and found == "UTF-8" and splittable(line, mark, quote):
            texts = read_quoted(spark, files, line, mark, quote)
            if texts is not None:
                return _in_splits(texts)
        lines = bool(quote) or found == "UTF-16" if multi_line is None else multi_line
        reader = spark.read.options(header=True, delimiter=mark, quote=quote, escape="\\", encoding=found, multiLine=lines)
        if schema is not None:
            df = reader.schema(schema).csv(files)
        elif all_text:
            df = reader.option("inferSchema", False).csv(files)
        elif infer_looks:
            df = reader.schema(infer_text_types(reader.option("inferSchema", False).csv(files))).csv(files)
        else:
            df = reader.option("inferSchema", True).csv(files)
        origin = {"FILE_NAME": F.col("_metadata.file_name")} if with_file_name else {}
        origin |= {"FILE_PATH": row_path()} if with_path else {}
        return df.withColumns(origin) if origin else df

    def _in_splits(texts: DataFrame) -> DataFrame:
        """The columns of a text frame in the wanted types, with the wanted origin."""
        names = [c for c in texts.columns if c not in ("_file", "_name")]
        if schema is not None:
            wanted = (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).fields
        elif all_text:
            wanted = [T.StructField(c, T.StringType()) for c in names]
        elif infer_looks:
            wanted = infer_text_types(texts.select(*[F.col(f"`{c}`") for c in names])).fields
        else:
            wanted = inferred(texts, names)
        typed = [_parsed(F.col(f"`{c}`"), f.dataType).alias(f.name) for c, f in zip(names, wanted, strict=False)]
        origin = [F.col("_name").alias("FILE_NAME")] if with_file_name else []
        origin += [row_path("_file").alias("FILE_PATH")] if with_path else []
        return texts.select(*typed, *origin)

    return union_by_name([read(*group) for group in groups])


def _parsed(text: Column, dtype: T.DataType) -> Column:
    """A text as the reader turns it into a value: through the parser of its own type."""
    if isinstance(dtype, T.StringType):
        return text
    kind = T.StructType([T.StructField("v", dtype)]).simpleString().removeprefix("struct<").removesuffix(">")
    quoted_text = F.concat(F.lit('"'), F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.from_csv(F.when(text.isNotNull(), quoted_text).otherwise(F.lit("")), F.lit(kind.replace(":", " ")), {"escape": "\\"})["v"]


def inferred(texts: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    """Types by Spark's own inference over all rows, from the texts written as plain records."""
    plain = texts.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names]), {"escape": "\\"}).alias("value"))
    reader = texts.sparkSession.read.options(inferSchema=True, escape="\\")
    found = reader._jreader.csv(getattr(plain._jdf, "as")(texts.sparkSession._jvm.org.apache.spark.sql.Encoders.STRING())).schema().json()
    kinds = T.StructType.fromJson(json.loads(found)).fields
    return [T.StructField(c, f.dataType) for c, f in zip(names, kinds, strict=True)]


# Types tried in order, each with the look a text must have. The cast alone would take "y" for
# a boolean, "1d" for a number, and would cut the time off a timestamp.
TEXT_TYPES = (
    (T.IntegerType(), r"^[+-]?\d+$"),
    (T.LongType(), r"^[+-]?\d+$"),
    (T.DoubleType(), r"^([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|NaN|[+-]?Infinity)$"),
    (T.BooleanType(), r"^(?i)(true|false)$"),
    (T.DateType(), r"^\d{4}-\d{1,2}-\d{1,2}$"),
    (T.TimestampNTZType(), r"^\d{4}-\d{1,2}-\d{1,2}[T ]?.*$"),
)


def infer_text_types(df: DataFrame) -> T.StructType:
    """Narrowest type that fits all values of each text column; one aggregate over all rows."""
    names = df.columns

    def misfit(name: str, dtype: T.DataType, look: str) -> Column:
        text = F.col(f"`{name}`")
        return text.isNotNull() & ~(text.rlike(look) & text.try_cast(dtype).isNotNull())

    misfits = [
        F.count_if(misfit(c, dtype, look)).alias(f"{i}_{k}")
        for i, c in enumerate(names)
        for k, (dtype, look) in enumerate(TEXT_TYPES)
    ]
    filled = [F.count(F.col(f"`{c}`")).alias(f"{i}_n") for i, c in enumerate(names)]
    row = df.agg(*misfits, *filled).first()

    def pick(i: int) -> T.DataType:
        fitting = [dtype for k, (dtype, _) in enumerate(TEXT_TYPES) if row[f"{i}_{k}"] == 0]
        return fitting[0] if fitting and row[f"{i}_n"] else T.StringType()

    return T.StructType([T.StructField(c, pick(i), True) for i, c in enumerate(names)])


def read_text_all(spark: SparkSession, path: str, kind: str = "csv", encoding: str = "UTF-8") -> DataFrame:
    """Everything as text: ``csv`` splits at commas, ``txt`` at bars."""
    delimiter = {"csv": ",", "txt": TEXT_DELIMITER}[kind]
    return read_delimited(spark, path, delimiter=delimiter, quote='"', encoding=encoding, all_text=True)


def header_groups(
    spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8"
) -> list[tuple[str, str, list[str]]]:
    """Files by equal encoding and first line: (encoding, line, files of the group).

    File names come to the driver only if there are several groups, since each group is a scan
    of its own; else the paths stay as they were given.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    heads = file_heads(spark, given, encoding)
    if encoding == "auto":
        heads = stage(heads, "heads")
    kinds = heads.groupBy("encoding", "line").agg(F.min("path").alias("first")).orderBy("first").collect()
    groups: dict[tuple[str, str], list[str]] = {(k["encoding"], k["line"]): [] for k in kinds}
    if len(kinds) == 1:
        groups = {key: given for key in groups}
    else:
        for row in heads.orderBy("path").toLocalIterator():
            groups[row["encoding"], row["line"]].append(row["path"])
    if encoding == "auto":
        unstage(heads)
    return [(found, line, files) for (found, line), files in groups.items()]


def read_files(
    spark: SparkSession, paths: str | Sequence[str], fmt: str, with_file_name: bool = False, with_path: bool = False, **options
) -> DataFrame:
    """One path or several as one DataFrame, united by column name, missing columns NULL.

    Delimited files with the same header share one scan, so many files stay one small plan.
    ``with_file_name`` adds FILE_NAME, the file each row came from, ``with_path`` FILE_PATH.
    """
    many = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "parquet":
        df = read_parquet(spark, many)
        origin = {"FILE_NAME": F.col("_metadata.file_name")} if with_file_name else {}
        return df.withColumns(origin | ({"FILE_PATH": row_path()} if with_path else {})) if origin or with_path else df
    if fmt in ("csv", "txt"):
        return read_delimited(spark, many, with_file_name=with_file_name, with_path=with_path, **options)
    if fmt in ("xlsx", "excel"):
        from millrace.sources.workbook import read_workbook

        frames = []
        for path in many:
            df = read_workbook(spark, path, **options)
            df = df.withColumn("FILE_NAME", F.lit(path.rsplit("/", 1)[-1])) if with_file_name else df
            frames.append(df.withColumn("FILE_PATH", F.lit(plain_path(path))) if with_path else df)
        return union_by_name(frames)
    raise ValueError(f"unknown source format {fmt}")
