import datetime as dt
import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F
from rows import rows_of

from placelytics.fixtures import Tables
from placelytics.operators import poslink
from placelytics.sources import readers, workbooks

SF = "/root/testdata/sf0.001"
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
HEADER = ["購入日", "商品名", "店舗", "購入日時"]
STYLES = (
    f'<styleSheet xmlns="{MAIN}"><numFmts><numFmt numFmtId="164" formatCode="yyyy/mm/dd&quot; x&quot;"/>'
    '<numFmt numFmtId="165" formatCode="[Red]0.0&quot; days&quot;"/></numFmts>'
    '<cellXfs><xf numFmtId="0"/><xf numFmtId="22"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>'
)


def serial(moment, first=dt.datetime(1899, 12, 30)):
    return (moment - first) / dt.timedelta(days=1)


def cell(value, place, shared):
    if value is None:
        return ""
    if isinstance(value, tuple):
        kind, style, value = value
        return f'<c r="{place}" t="{kind}" s="{style}"><v>{value}</v></c>'
    if isinstance(value, dt.datetime):
        return f'<c r="{place}" t="d"><v>{value.isoformat()}</v></c>'
    if isinstance(value, str) and shared is not None:
        shared.append(value)
        return f'<c r="{place}" t="s"><v>{len(shared) - 1}</v></c>'
    if isinstance(value, str):
        return f'<c r="{place}" t="inlineStr"><is><r><t>{escape(value[:1])}</t></r><r><t>{escape(value[1:])}</t></r></is></c>'
    return f'<c r="{place}"><v>{value!r}</v></c>'


def workbook(path, *sheets, inline=False, settings=""):
    """A workbook of sheets, lists of rows."""
    path.parent.mkdir(parents=True, exist_ok=True)
    shared = None if inline else []
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        names = "".join(f'<sheet name="S{i}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i in range(len(sheets)))
        relations = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{relations}">{settings}<sheets>{names}</sheets></workbook>')
        targets = "".join(f'<Relationship Id="rId{i + 1}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets)))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{targets}</Relationships>")
        book.writestr("xl/styles.xml", STYLES)
        for i, rows in enumerate(sheets):
            lines = (
                f'<row r="{n}">' + "".join(cell(v, f"{chr(65 + c)}{n}", shared) for c, v in enumerate(row)) + "</row>"
                for n, row in enumerate(rows, 1)
            )
            book.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
        if shared:
            items = "".join(f'<si><t xml:space="preserve">{escape(t)}</t><rPh sb="0" eb="1"><t>hint</t></rPh></si>' for t in shared)
            book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{items}</sst>')


def test_folder_of_workbooks_as_of_csv_files(spark, tmp_path):
    sold = dt.datetime(2024, 5, 10, 9, 30)
    workbook(tmp_path / "may" / "1.xlsx", [HEADER, [20240510, "tea", 1, ("n", 1, serial(sold))], [], [20240510, None, 1, sold]])
    shuffled = ["note", "購入日時", "店舗", "商品名", "購入日"]
    workbook(tmp_path / "may" / "2.xlsx", [[], shuffled, ["x", "2024-05-11 10:00:00", "1234", "c&ke", "20240511"], ["y"]], inline=True)
    (tmp_path / "may" / "~$2.xlsx").write_bytes(b"lock")
    (tmp_path / "may" / "readme.txt").write_text("no workbook")
    pos = readers.read_pos(spark, str(tmp_path / "may"), format="workbook")
    assert rows_of(pos.withColumn("datetime", F.col("datetime").cast("string"))) == [
        ("001", "tea", "2024-05-10 09:30:00"),
        ("001", None, "2024-05-10 09:30:00"),
        ("1234", "c&ke", "2024-05-11 10:00:00"),
    ]
    day = readers.read_pos(spark, str(tmp_path / "may"), format="workbook", purchase_days=["2024-05-11"])
    assert rows_of(day, "item_name") == [("c&ke",)]


def test_sales_from_workbooks_equal_those_of_the_table(spark, tmp_path):
    tables = Tables(spark, SF)
    lines = tables.pos.select("item_name", "shop_code", F.col("datetime").cast("timestamp_ntz")).collect()
    assert len(lines) > 20
    for part in range(3):
        rows = [[None, r[0], r[1], r[2]] for r in lines[part::3]]
        workbook(tmp_path / "pos" / f"{part}.xlsx", [HEADER, *rows], inline=part == 1)
    kind = dict(tables.pos.dtypes)["datetime"]
    read = readers.read_pos(spark, str(tmp_path / "pos"), format="workbook", timestamp_type=kind)
    assert rows_of(poslink.pos_sales(read, tables.shops)) == rows_of(poslink.pos_sales(tables.pos, tables.shops))


def test_kinds_of_cells(spark, tmp_path):
    rows = [
        ["a"],
        [7.0], [0.25], [("n", 3, 3)], [("n", 2, 45422)], [("n", 1, serial(dt.datetime(2024, 5, 10, 9, 30, 0, 125000)))],
        [("n", 1, 59)], [("n", 1, 61)], [("b", 0, 1)], [("e", 0, "#N/A")], [("str", 0, "made")], [" kept "],
    ]
    workbook(tmp_path / "k.xlsx", rows)
    path = str(tmp_path / "k.xlsx")
    assert [r.a for r in workbooks.read_sheets(spark, path, ["a"]).collect()] == [
        "7", "0.25", "3", "2024-05-10 00:00:00", "2024-05-10 09:30:00.125",
        "1900-02-28 00:00:00", "1900-03-01 00:00:00", "true", "made", " kept ",
    ]
    workbook(tmp_path / "old.xlsx", [["a"], [("n", 1, 1)]], settings='<workbookPr date1904="1"/>')
    assert workbooks.read_sheets(spark, str(tmp_path / "old.xlsx"), ["a"]).first().a == "1904-01-02 00:00:00"


def test_sheet_by_name_and_what_is_missing(spark, tmp_path):
    path = str(tmp_path / "s.xlsx")
    workbook(tmp_path / "s.xlsx", [["a"], ["first"]], [["a"], ["second"]], [])
    assert workbooks.read_sheets(spark, path, ["a"], sheet="S1").first().a == "second"
    for columns, sheet, complaint in ((["a", "b"], "S0", "no column b"), (["a"], "S9", "no sheet S9"), (["a"], "S2", "no column a")):
        with pytest.raises(Exception, match=complaint):
            workbooks.read_sheets(spark, path, columns, sheet=sheet).collect()


def test_more_rows_than_a_batch_and_an_empty_folder(spark, tmp_path):
    n = workbooks._BATCH + 5
    workbook(tmp_path / "many" / "m.xlsx", [["a"], *[[i] for i in range(n)]])
    read = workbooks.read_sheets(spark, str(tmp_path / "many"), ["a"]).select(F.col("a").cast("int"))
    assert [r.a for r in read.collect()] == list(range(n))
    (tmp_path / "none").mkdir()
    assert workbooks.read_sheets(spark, str(tmp_path / "none"), ["a"]).collect() == []
