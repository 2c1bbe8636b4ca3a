"""Delimited text with quoted line breaks, read by many tasks a file.

Whether a line break ends a record depends on all quotes before it. A line is taken as a function from
"begins inside quotes" to "ends inside quotes". Files are read in splits as usual; each split is summed
up as one such function, a scan over the few splits of a file gives the state in which each begins, and
then every line of a split knows its own. Lines that are records of their own are parsed where they are;
only lines of records with breaks are brought together, by the line that begins their record.

This holds for text whose quoted values are closed before a delimiter or line end and have quotes only
behind the escape character. One pass over the lines finds out (:func:`well_formed`); other text is left to the
reader that takes files whole, since what that makes of stray quotes depends on its state.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.joins import join_groups

ESCAPE = "\\"


def _parts(delimiter: str, quote: str) -> tuple[str, str, str]:
    """Patterns of a field, of the rest of a quoted value, and of the delimiter."""
    d, q, e = (re.escape(x) for x in (delimiter, quote, ESCAPE))
    rest = rf"(?:[^{q}{e}]|{e}.)*+"
    return rf"(?:{q}{rest}{q}|(?!{q})[^{d}]*+)", rest, d


def closes(delimiter: str, quote: str, inside: bool) -> str:
    """Pattern of lines that end outside quotes, if they begin ``inside`` or outside them.

    A field is quoted only if it begins with the quote; quotes elsewhere are letters.
    """
    field, rest, d = _parts(delimiter, quote)
    begin = rf"{rest}{re.escape(quote)}" if inside else field
    return rf"(?s)\A{begin}(?:{d}{field})*+\z"


def opens(delimiter: str, quote: str, inside: bool) -> str:
    """Pattern of lines that end inside quotes."""
    field, rest, d = _parts(delimiter, quote)
    q = re.escape(quote)
    last = rf"{q}{rest}\\?\z"
    if inside:
        return rf"(?s)\A(?:{rest}\\?\z|{rest}{q}(?:{d}{field})*+{d}{last})"
    return rf"(?s)\A(?:{field}{d})*+{last}"


def _lines(spark: SparkSession, paths: Sequence[str], delimiter: str, quote: str) -> DataFrame:
    """Lines with file, split and place, and where each function takes the state.

    Files whose first line ends in CRLF have this line end; it is left out of ``line``.
    """
    text = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    )
    heads = text.where("split = 0").groupBy("file").agg(F.min("at").alias("head"), F.min_by("line", "at").endswith("\r").alias("crlf"))
    text = join_groups(text, heads, ["file"], "inner").withColumn("line", F.when(F.col("crlf"), F.regexp_replace("line", "\r\\z", "")).otherwise(F.col("line")))
    some = F.contains("line", F.lit(quote))
    to = {name: F.when(some, (~F.col("line").rlike(closes(delimiter, quote, state))).cast("int")).otherwise(int(state)) for name, state in (("out_to", False), ("in_to", True))}
    return text.withColumns(to)


def _run(frame: DataFrame, over, begin: Column) -> tuple[Column, Column]:
    """State before and after each row, from the state ``begin`` before the first of the window.

    Of the functions so far, the last constant one sets the state, and every swap since turns it.
    """
    fixed, swap = F.col("out_to") == F.col("in_to"), (F.col("out_to") > F.col("in_to")).cast("int")
    upto = over.rowsBetween(Window.unboundedPreceding, 0)
    before = over.rowsBetween(Window.unboundedPreceding, -1)

    def state(window):
        swaps = F.coalesce(F.sum(swap).over(window), F.lit(0))
        last = F.last(F.when(fixed, F.struct(F.col("out_to").alias("to"), F.col("_swaps").alias("at"))), True).over(window)
        return F.when(last.isNull(), (begin + swaps) % 2).otherwise((last["to"] + swaps - last["at"]) % 2)

    return state(before), state(upto)


def _with_states(frame: DataFrame, keys: Sequence[str], order: str, begin: Column) -> DataFrame:
    over = Window.partitionBy(*keys).orderBy(order)
    swap = (F.col("out_to") > F.col("in_to")).cast("int")
    counted = frame.withColumn("_swaps", F.sum(swap).over(over.rowsBetween(Window.unboundedPreceding, 0)))
    first, last = _run(counted, over, begin)
    return counted.withColumns({"begins": first, "ends": last}).drop("_swaps")


def placed_lines(spark: SparkSession, paths: Sequence[str], delimiter: str, quote: str) -> DataFrame:
    """Lines with the state in which they begin (``inside``) and end (``after``), and the line that began
    the last record of the splits before (``open``).
    """
    lines = _lines(spark, paths, delimiter, quote)
    both = _with_states(_with_states(lines, ["file", "split"], "at", F.lit(0)).withColumnsRenamed({"begins": "b0", "ends": "e0"}), ["file", "split"], "at", F.lit(1))
    both = both.withColumnsRenamed({"begins": "b1", "ends": "e1"})
    splits = both.groupBy("file", "split").agg(
        F.max_by("e0", "at").alias("out_to"), F.max_by("e1", "at").alias("in_to"),
        F.max(F.when(F.col("b0") == 0, F.col("at"))).alias("start0"), F.max(F.when(F.col("b1") == 0, F.col("at"))).alias("start1"),
    )
    splits = _with_states(splits, ["file"], "split", F.lit(0))
    started = F.when(F.col("begins") == 0, F.col("start0")).otherwise(F.col("start1"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "split", F.col("begins").alias("state"), F.last(started, True).over(earlier).alias("open"))
    placed = join_groups(both, splits, ["file", "split"], "inner")
    inside = F.when(F.col("state") == 0, F.col("b0")).otherwise(F.col("b1"))
    after = F.when(F.col("state") == 0, F.col("e0")).otherwise(F.col("e1"))
    return placed.select("file", "name", "split", "at", "line", "head", "open", inside.alias("inside"), after.alias("after"))


def well_formed(placed: DataFrame, delimiter: str, quote: str) -> bool:
    """Whether every line fits the rule in the state in which it begins, and no file ends inside quotes;
    the first line that does not fit is found, as all states before it are right.
    """
    fits = [F.col("line").rlike(closes(delimiter, quote, s)) | F.col("line").rlike(opens(delimiter, quote, s)) for s in (False, True)]
    fine = F.when(F.col("inside") == 0, fits[0]).otherwise(fits[1])
    stray = F.count_if(F.contains("line", F.lit(quote)) & ~fine)
    files = placed.groupBy("file").agg(stray.alias("stray"), F.max_by("after", F.struct("split", "at")).alias("open_end"))
    return files.where("stray > 0 OR open_end = 1").isEmpty()


def records(placed: DataFrame) -> DataFrame:
    """``file``, ``name`` and ``record`` of all records but each file's first, the header."""
    whole = placed.where("inside = 0 AND after = 0").select("file", "name", "head", "at", F.col("line").alias("record"))
    parts = placed.where("inside = 1 OR after = 1")
    own = F.last(F.when(F.col("inside") == 0, F.col("at")), True).over(Window.partitionBy("file", "split").orderBy("at"))
    parts = parts.withColumn("record_at", F.coalesce(own, "open"))
    joined = parts.groupBy("file", "name", "head", "record_at").agg(F.array_sort(F.collect_list(F.struct("split", "at", "line"))).alias("l"))
    joined = joined.select("file", "name", "head", F.col("record_at").alias("at"), F.array_join("l.line", "\n").alias("record"))
    return whole.unionByName(joined).where("at <> head AND record <> ''").select("file", "name", "record")


def splittable(line: str, delimiter: str, quote: str) -> bool:
    """Whether a header of one line can be told, so that the file can be read in splits."""
    pattern = closes(delimiter, quote, False).replace(r"\z", r"\Z")
    return len(delimiter) == 1 and len(quote) == 1 and quote != ESCAPE and "\r" not in line.rstrip("\r") and re.match(pattern, line.rstrip("\r")) is not None


def header_names(spark: SparkSession, line: str, delimiter: str, quote: str) -> list[str]:
    """Column names as Spark's reader makes them from a header."""
    reader = spark.read.options(header=True, delimiter=delimiter, quote=quote, escape=ESCAPE)
    return reader.csv(spark.sparkContext.parallelize([line.rstrip("\r")], 1)).columns


def read_quoted(spark: SparkSession, paths: Sequence[str], line: str, delimiter: str, quote: str) -> DataFrame | None:
    """All columns as text, with ``_file`` and ``_name``; equal to the reader that takes files whole.
    None if the text is not well-formed.
    """
    placed = placed_lines(spark, paths, delimiter, quote)
    if not well_formed(placed, delimiter, quote):
        return None
    names = header_names(spark, line, delimiter, quote)
    schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
    rows = records(placed)
    parsed = F.from_csv("record", F.lit(schema), {"delimiter": delimiter, "quote": quote, "escape": ESCAPE})
    return rows.select(F.col("file").alias("_file"), F.col("name").alias("_name"), parsed.alias("_r")).select("_file", "_name", "_r.*")
