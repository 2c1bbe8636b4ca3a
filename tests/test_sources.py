"""Sources and sinks: delimited text, encodings, workbooks, listings, JDBC options."""

import datetime as dt
import hashlib
import io
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.plans import exports
from millrace.session import scratch_dir
from millrace.sources import files, jdbc, listing, workbook
from millrace.sources.spec import Source


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def put(tmp_path, name, content):
    path = tmp_path / name
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_quotes_are_text_unless_asked_for(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'id|t\r\n1|"x"\r\n')
    assert tuples(files.read_delimited(spark, path)) == [(1, '"x"')]
    path = put(tmp_path, "b.csv", 'id|t\n1|"x\ny"\n')
    assert tuples(files.read_delimited(spark, path, quote='"')) == [(1, "x\ny")]


@pytest.mark.parametrize(
    "line, given, expected",
    [("a;b", ";", ";"), ("a|b", ";", "|"), ("a,b", ";", ","), ("a", ";", ";"), ("a|b,c", ",", ",")],
)
def test_delimiter_choice(line, given, expected):
    assert files.choose_delimiter(line, given) == expected


def test_encodings(spark, tmp_path):
    texts = {"bom8.txt": b"\xef\xbb\xbfid|t\n", "u16.txt": "id|t\n1|đ\n".encode("utf-16"), "u8.txt": "đ".encode(), "l1.txt": b"caf\xe9"}
    for name, content in texts.items():
        put(tmp_path, name, content)
    found = listing.detect_encoding(spark, str(tmp_path))
    assert {r["filename"]: r["encoding"] for r in found.collect()} == {
        "bom8.txt": "UTF-8", "u16.txt": "UTF-16", "u8.txt": "UTF-8", "l1.txt": "ISO-8859-1",
    }
    assert tuples(files.read_delimited(spark, str(tmp_path / "u16.txt"), encoding="auto")) == [(1, "đ")]
    put(tmp_path, "v.txt", "id|t\n2|ê\n")
    both = files.read_files(spark, [str(tmp_path / n) for n in ("u16.txt", "v.txt")], "txt", encoding="auto")
    assert tuples(both) == [(1, "đ"), (2, "ê")]


def test_listing_hash_and_fallback(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "archive").mkdir()
    put(tmp_path / "archive", "a.csv", "x" * 2048)
    archive = listing.list_directory(spark, str(tmp_path / "archive"))
    empty = archive.where("false")
    row = listing.hash_files(listing.list_with_fallback(empty, archive)).first()
    assert (row["filename"], row["st_size"], row["file_size"]) == ("a.csv", 2048, "2.00 KiB")
    assert row["hash_check_sum"] == hashlib.blake2b(b"x" * 2048).hexdigest()
    assert listing.list_with_fallback(archive, archive).count() == 1


def test_many_paths_with_different_headers(spark, tmp_path):
    paths = [put(tmp_path, f"{i}.csv", body) for i, body in enumerate(["id|a\n1|x\n", "id|a\n2|y\n", "b|id\n9|3\n"])]
    out = files.read_files(spark, paths, "csv", with_file_name=True)
    assert tuples(out.select("id", "a", "b", "FILE_NAME")) == [(1, "x", None, "0.csv"), (2, "y", None, "1.csv"), (3, None, 9, "2.csv")]
    assert len(files.header_groups(spark, paths)) == 2


def test_sampled_types(spark):
    df = spark.createDataFrame(
        [
            ("1", "1.5", "true", "2024-01-01", "x", None, "y", "1d", "2024-01-01"),
            ("3000000000", "2", "false", "2024-01-02", "1", None, "n", "2", "2024-01-01 10:00:00"),
        ],
        "a string, b string, c string, d string, e string, f string, g string, h string, i string",
    )
    assert files.infer_text_types(df).simpleString() == (
        "struct<a:bigint,b:double,c:boolean,d:date,e:string,f:string,g:string,h:string,i:timestamp_ntz>"
    )


def test_delimited_export_is_crlf_text(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, t string")
    assert exports.write_delimited(df, path, single_file=True) == 2
    (part,) = (tmp_path / "out.csv").glob("part-*")
    assert part.read_bytes().splitlines(keepends=True)[:2] == [b"id|t\r\n", b"1|a\r\n"]
    odd = spark.createDataFrame(
        [(' a "b" ', "x|y", "", dt.datetime(2024, 1, 2, 3)), (None, "l\nm", "z", dt.datetime(2024, 1, 2, 3, 4, 5, 600000))],
        "p string, q string, r string, t timestamp_ntz",
    )
    exports.write_delimited(odd, path, single_file=True)
    (part,) = (tmp_path / "out.csv").glob("part-*")
    text = part.read_bytes().decode()
    assert text == 'p|q|r|t\r\n" a ""b"" "|"x|y"||2024-01-02 03:00:00\r\n|"l\r\nm"|z|2024-01-02 03:04:05.6\r\n'
    with pytest.raises(ValueError, match=".csv"):
        exports.write_delimited(df, str(tmp_path / "out"))
    with pytest.raises(ValueError, match="unknown sink format"):
        exports.write_sink(df, "avro", path)
    with pytest.raises(ValueError, match="unknown source format"):
        files.read_files(spark, path, "avro")


def test_rows_per_file(spark, monkeypatch):
    monkeypatch.setattr(exports, "ROWS_PER_FILE", 10)
    path = scratch_dir(spark, "sized")
    assert exports.write_parquet(spark.range(100).coalesce(1), path) == 100
    assert listing.list_directory(spark, path, "*.parquet").count() == 10


def test_memory_sources(spark):
    frame = pd.DataFrame({"a": [1, 2]})
    assert Source(frame, "memory").read(spark).count() == 2
    assert Source(lambda: frame, "memory").read(spark).count() == 2
    assert Source(lambda session: session.range(3), "memory").read(spark).count() == 3


def test_jdbc_options():
    con = jdbc.JdbcConnection("jdbc:x:y", "a.Driver", {"user": "u"})
    options = jdbc.read_options(con, "SELECT\n* FROM t", "d", "2024-01-01", "2024-02-01", 8)
    assert options["dbtable"] == "(SELECT\n* FROM t) TEMP"
    assert (options["numPartitions"], options["partitionColumn"], options["fetchsize"]) == ("8", "d", "200000")
    assert jdbc.read_options(con, "S.SELECTED")["dbtable"] == "S.SELECTED"
    with pytest.raises(ValueError, match="bounds"):
        jdbc.read_options(con, "t", "d")
    assert jdbc.write_options(con, "t", 4)["batchsize"] == "1048576"


MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def book(sheets, shared=(), styles=None):
    """A minimal workbook: sheet name -> list of (row number, [(ref, xml)])."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        tags = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f"<workbook {MAIN} {REL}><sheets>{tags}</sheets></workbook>")
        links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{n}">{"".join(cells)}</row>' for n, cells in rows)
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {MAIN}><sheetData>{body}</sheetData></worksheet>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        if styles:
            z.writestr("xl/styles.xml", styles)
    return out.getvalue()


def test_workbook_sheets_areas_and_types(spark, tmp_path):
    sheets = {
        "Jan": [
            (1, ['<c r="B1" t="s"><v>2</v></c>']),
            (3, ['<c r="B3" t="s"><v>0</v></c>', '<c r="C3" t="s"><v>1</v></c>']),
            (4, ['<c r="B4"><v>1</v></c>', '<c r="C4" t="inlineStr"><is><t>x</t></is></c>']),
            (5, ['<c r="B5"><v>2</v></c>', '<c r="C5" t="e"><v>#N/A</v></c>']),
            (6, []),
            (7, ['<c r="B7"><v>9</v></c>']),
        ],
        "Feb": [
            (1, ['<c r="A1" t="s"><v>0</v></c>', '<c r="B1" t="str"><v>flag</v></c>']),
            (2, ['<c r="A2"><v>3</v></c>', '<c r="B2" t="b"><v>1</v></c>']),
        ],
    }
    path = put(tmp_path, "m.xlsx", book(sheets, ["id", "name", "Title"]))
    one = workbook.read_workbook(spark, path, "0!B3:C5")
    assert one.dtypes == [("id", "int"), ("name", "string")]
    assert tuples(one) == [(1, "x"), (2, None)]
    both = files.read_files(spark, path, "xlsx", data_address=["Jan!B3", "'Feb'!A1", "Mar!A1"])
    assert tuples(both.select("id", "name", "flag")) == [(1, "x", None), (2, None, None), (3, None, True), (9, None, None)]
    found = workbook.read_workbook(spark, path, "Jan!", promote_header=True)
    assert tuples(found) == [(1, "x"), (2, None), (9, None)]
    cells = workbook.cell_table(workbook.select_area(workbook.workbook_rows(spark, path), "Jan!B3:C4"))
    assert cells.count() == 4
    with pytest.raises(ValueError, match="none of the sheets"):
        workbook.read_workbook(spark, path, "Mar!A1")


def test_date_cells(spark, tmp_path):
    styles = (
        f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="170" formatCode="dd/mm/yyyy hh:mm"/>'
        '<numFmt numFmtId="171" formatCode="[Red]0.0 &quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/>'
        '<xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>'
    )
    head = "".join(f'<c r="{c}1" t="inlineStr"><is><t>{c}</t></is></c>' for c in "ABCD")
    row = '<c r="A2"><v>45292</v></c><c r="B2" s="1"><v>45292</v></c><c r="C2" s="2"><v>45292.5</v></c><c r="D2" s="3"><v>45292.5</v></c>'
    path = put(tmp_path, "d.xlsx", book({"S": [(1, [head]), (2, [row])]}, styles=styles))
    day = dt.datetime(2024, 1, 1)
    out = workbook.read_workbook(spark, path)
    assert [t for _, t in out.dtypes] == ["int", "timestamp_ntz", "timestamp_ntz", "double"]
    assert tuples(out) == [(45292, day, day.replace(hour=12), 45292.5)]


def test_header_ties_go_to_the_upper_row(spark):
    rows = spark.createDataFrame(
        [("s", 1, ["t", None]), ("s", 2, ["a", "b"]), ("s", 3, ["c", "d"]), ("s", 4, ["e", "e", "e"])],
        "sheet string, row_index int, cells array<string>",
    )
    assert workbook.header_row(rows, ["sheet"]).first()["header_row"] == 2
    assert workbook.below_header(rows, ["sheet"]).count() == 2


@pytest.mark.parametrize("letters, index", [("A", 0), ("Z", 25), ("AA", 26), ("XFD", 16383)])
def test_column_letters(letters, index):
    assert workbook.column_index(letters) == index


def test_addresses():
    assert workbook.parse_address("0!") == ("0", (1, 0, None, None))
    assert workbook.parse_address("'My Sheet'!$B$3:C35") == ("My Sheet", (3, 1, 35, 2))
    with pytest.raises(ValueError):
        workbook.parse_address("0!??")
