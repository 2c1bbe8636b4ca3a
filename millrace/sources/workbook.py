"""Workbooks (xlsx): rows of cells, header promotion, several sheets.

A workbook is a zip of XML parts, so each file is opened by one task with the standard
library; rows of all files then form one distributed table of cells.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import join_groups
from millrace.operators.relational import union_by_name
from millrace.sources.files import infer_text_types

CELL_ROWS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("sheet_index", T.IntegerType()),
        T.StructField("sheet", T.StringType()),
        T.StructField("row_index", T.IntegerType()),
        T.StructField("first_col", T.IntegerType()),
        T.StructField("cells", T.ArrayType(T.StringType())),
    ]
)


def column_index(letters: str) -> int:
    """``A`` is 0, ``Z`` is 25, ``AA`` is 26."""
    n = 0
    for ch in letters.upper():
        n = n * 26 + ord(ch) - 64
    return n - 1


def parse_address(address: str) -> tuple[str, tuple[int, int, int | None, int | None]]:
    """``0!B3:C35`` as the sheet and (first row, first column, last row, last column), 1-based rows."""
    sheet, _, area = address.partition("!")
    sheet = sheet.removeprefix("'").removesuffix("'")
    m = re.fullmatch(r"(?:\$?([A-Za-z]+)\$?(\d+))?(?::\$?([A-Za-z]+)\$?(\d+))?", area)
    if m is None:
        raise ValueError(f"bad data address {address}")
    c1, r1, c2, r2 = m.groups()
    return sheet, (
        int(r1) if r1 else 1,
        column_index(c1) if c1 else 0,
        int(r2) if r2 else None,
        column_index(c2) if c2 else None,
    )


def _date_styles(book) -> set[int]:
    """Cell styles that show a number as a date or time."""
    from xml.etree.ElementTree import fromstring

    if "xl/styles.xml" not in book.namelist():
        return set()
    root = fromstring(book.read("xl/styles.xml"))
    dated = set(range(14, 23)) | {45, 46, 47}  # fixed values: built-in date and time formats
    for fmt in root.iter():
        if fmt.tag.endswith("}numFmt"):
            code = re.sub(r'"[^"]*"|\\.|\[(?![hms]+\])[^\]]*\]', "", fmt.get("formatCode", ""))
            if re.search(r"[dmyhs]", code, re.IGNORECASE):
                dated.add(int(fmt.get("numFmtId")))
    cells = next((e for e in root if e.tag.endswith("}cellXfs")), ())
    return {i for i, xf in enumerate(cells) if int(xf.get("numFmtId", 0)) in dated}


def _date_text(serial: str, base_1904: bool) -> str:
    """Serial number of a date cell as ISO text."""
    from datetime import datetime, timedelta

    base = datetime(1904, 1, 1) if base_1904 else datetime(1899, 12, 30)
    moment = base + timedelta(milliseconds=round(float(serial) * 86400000))
    return moment.isoformat(sep=" ", timespec="milliseconds").removesuffix(".000")


def _sheet_rows(
    book, part: str, shared: list[str], dated: set[int], base_1904: bool
) -> Iterator[tuple[int, dict[int, str | None]]]:
    from xml.etree.ElementTree import iterparse

    def text_of(element) -> str:
        return "".join(t.text or "" for t in element.iter() if t.tag.endswith("}t"))

    with book.open(part) as stream:
        next_row = 1
        for _, row in iterparse(stream):
            if not row.tag.endswith("}row"):
                continue
            number = int(row.get("r", next_row))
            values: dict[int, str | None] = {}
            for cell in row:
                ref = re.match(r"[A-Z]+", cell.get("r", ""))
                col = column_index(ref.group()) if ref else len(values)
                kind = cell.get("t", "n")
                raw = next((v.text for v in cell if v.tag.endswith("}v")), None)
                if kind == "s" and raw is not None:
                    raw = shared[int(raw)]
                elif kind == "inlineStr":
                    raw = text_of(cell)
                elif kind == "b" and raw is not None:
                    raw = "true" if raw == "1" else "false"
                elif kind == "e":
                    raw = None
                elif kind == "n" and raw and int(cell.get("s", 0)) in dated:
                    raw = _date_text(raw, base_1904)
                values[col] = raw or None
            yield number, values
            next_row = number + 1
            row.clear()


def _workbook_rows(content: bytes) -> Iterator[tuple[int, str, int, list[str | None]]]:
    import io
    import zipfile
    from xml.etree.ElementTree import fromstring

    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            for item in fromstring(book.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in item.iter() if t.tag.endswith("}t")))
        links = {r.get("Id"): r.get("Target") for r in fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        dated = _date_styles(book)
        main = fromstring(book.read("xl/workbook.xml"))
        base_1904 = any(e.tag.endswith("}workbookPr") and e.get("date1904") in ("1", "true") for e in main)
        sheets = next(e for e in main if e.tag.endswith("}sheets"))
        for index, sheet in enumerate(sheets):
            target = links[next(v for k, v in sheet.attrib.items() if k.endswith("}id"))].lstrip("/")
            part = target if target.startswith("xl/") else f"xl/{target}"
            for number, values in _sheet_rows(book, part, shared, dated, base_1904):
                width = max(values, default=-1) + 1
                yield index, sheet.get("name"), number, [values.get(c) for c in range(width)]


def _cell_batches(batches: Iterator[pd.DataFrame], flush: int = 5000) -> Iterator[pd.DataFrame]:
    names = CELL_ROWS.fieldNames()
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows = []
            for index, sheet, number, cells in _workbook_rows(content):
                rows.append((path, index, sheet, number, 0, cells))
                if len(rows) == flush:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)


def rows_of(files: DataFrame) -> DataFrame:
    """Every row of every sheet of the workbooks in ``files`` (path, content), as an array of texts."""
    return files.select("path", "content").mapInPandas(_cell_batches, CELL_ROWS)


def workbook_rows(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """:func:`rows_of` the workbooks at ``paths``."""
    return rows_of(spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths)))


def cell_table(rows: DataFrame) -> DataFrame:
    """One line per filled cell: path, sheet, row, column, value."""
    cells = rows.select(
        "path", "sheet", "row_index", "first_col", F.posexplode("cells").alias("col_index", "value")
    )
    placed = cells.withColumn("col_index", F.col("col_index") + F.col("first_col")).drop("first_col")
    return placed.where(F.col("value").isNotNull())


def _in_sheet(sheet: str) -> Column:
    by_name = F.col("sheet") == sheet
    return (by_name | (F.col("sheet_index") == int(sheet))) if sheet.isdigit() else by_name


def select_area(rows: DataFrame, address: str) -> DataFrame:
    """Rows and cells of one data address."""
    sheet, (r1, c1, r2, c2) = parse_address(address)
    chosen = rows.where(_in_sheet(sheet) & (F.col("row_index") >= r1))
    if r2 is not None:
        chosen = chosen.where(F.col("row_index") <= r2)
    last = F.size("cells") if c2 is None else F.least(F.lit(c2 + 1), F.size("cells"))
    cut = F.slice("cells", F.lit(c1 + 1), F.greatest(last - c1, F.lit(0)))
    return chosen.withColumns({"cells": cut, "first_col": F.lit(c1)})


def header_row(rows: DataFrame, key: Sequence[str] = ("path", "sheet"), sample: int | None = None) -> DataFrame:
    """Per sheet the row with the most distinct filled cells, of all or of the first ``sample``; ties go
    to the upper row.
    """
    distinct = F.size(F.array_distinct(F.array_compact("cells")))
    rank = F.struct(distinct.alias("n"), (-F.col("row_index")).alias("r"))
    head = rows if sample is None else rows.where(F.col("row_index") <= sample)
    best = head.groupBy(*key).agg(F.max_by(F.struct("row_index", "cells"), rank).alias("h"))
    return best.select(*key, F.col("h.row_index").alias("header_row"), F.col("h.cells").alias("header"))


def below_header(rows: DataFrame, key: Sequence[str] = ("path", "sheet"), sample: int | None = None) -> DataFrame:
    """Rows under their sheet's header, with the header beside them."""
    heads = header_row(rows, key, sample)
    return join_groups(rows, heads, key, "inner").where(F.col("row_index") > F.col("header_row"))


def to_columns(rows: DataFrame, header: Sequence[str | None]) -> DataFrame:
    """Cells as named text columns; blank headers are skipped and all-NULL rows dropped."""
    columns = [
        F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(header) if name is not None and name != ""
    ]
    return rows.select(*columns).na.drop("all")


def read_workbook(
    spark: SparkSession,
    path: str,
    data_address: str | Sequence[str] = "0!",
    infer: bool = True,
    promote_header: bool = False,
) -> DataFrame:
    """Sheets of a workbook as one table, united by name; requested sheets that do not exist are skipped.

    The first row of the area is the header, or with ``promote_header`` the most diverse
    row. Types are those that all cells of a column fit.
    """
    rows = workbook_rows(spark, path)
    addresses = [data_address] if isinstance(data_address, str) else list(data_address)
    frames = []
    for address in addresses:
        area = select_area(rows, address)
        if promote_header:
            head = header_row(area).select("header_row", "header").first()
        else:
            first = F.struct(F.col("row_index").alias("header_row"), F.col("cells").alias("header"))
            head = area.agg(F.min_by(first, "row_index").alias("h")).select("h.*").first()
        if head is None or head["header"] is None:
            continue
        table = to_columns(area.where(F.col("row_index") > head["header_row"]), head["header"])
        if infer:
            types = infer_text_types(table)
            table = table.select([F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in types.fields])
        frames.append(table)
    if not frames:
        raise ValueError(f"none of the sheets exist: {addresses}")
    return union_by_name(frames)
