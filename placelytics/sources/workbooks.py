"""Sheets of spreadsheet workbooks (Office Open XML), read by the executors.

Spark lists and fetches the files, so any file system it can read will do, and each workbook is decoded
where its bytes are. A sheet is parsed as a stream; of a workbook only its file and its shared strings, which the
format bounds, are held. Every cell comes out as text, as from a CSV file, so types are declared by
the caller and not guessed from values.
"""

from __future__ import annotations

import datetime as dt
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placelytics.schemas import SchemaError

# Fixed values of the format: namespaces, built-in number formats that show a date or a time, error values.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])

_BATCH = 10_000


def read_sheets(spark: SparkSession, path: str, columns: Sequence[str], *, sheet: str | None = None) -> DataFrame:
    """``columns``, all text, of every ``.xlsx`` workbook under ``path``, a file or a folder.

    The first row of a sheet names its columns, in any order; a workbook without one of ``columns`` fails the
    read. ``sheet`` names the sheet, else the first is taken. Dates come out as ``yyyy-MM-dd HH:mm:ss``
    with a fraction if there is one, whole numbers without a point, empty cells as null; rows without any of
    the columns are left out. Lock files (``~$...``) are not workbooks.
    """
    columns = list(columns)
    files = (
        spark.read.format("binaryFile")
        .options(pathGlobFilter="*.xlsx", recursiveFileLookup="true")
        .load(path)
        .where(~F.col("path").rlike(r"/(~|%7E)(\$|%24)[^/]*$"))
        .select("path", "content")
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = sheet_rows(content.as_py(), columns, sheet, name.as_py())
                while chunk := [row for _, row in zip(range(_BATCH), rows)]:
                    cells = zip(*chunk, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cells], names=columns)

    return files.mapInArrow(decode, ", ".join(f"`{c}` string" for c in columns))


def sheet_rows(content: bytes, columns: Sequence[str], sheet: str | None, name: str) -> Iterator[list[str | None]]:
    """The rows of one sheet below its header, as texts of ``columns``."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        member, from_1904 = _sheet_member(book, sheet, name)
        shared, dated = _shared_strings(book), _date_styles(book)
        at: list[int] | None = None
        with book.open(member) as stream:
            for row in _elements(stream, "row"):
                cells = {}
                for i, cell in enumerate(row.iterfind(f"{_MAIN}c")):
                    cells[_column(cell.get("r"), i)] = _text(cell, shared, dated, from_1904)
                if at is None:
                    if not any(cells.values()):
                        continue
                    places = {text: place for place, text in sorted(cells.items(), reverse=True)}
                    missing = [c for c in columns if c not in places]
                    if missing:
                        raise SchemaError(f"{name}: no column " + ", ".join(missing))
                    at = [places[c] for c in columns]
                else:
                    values = [cells.get(place) for place in at]
                    if any(v is not None for v in values):
                        yield values
        if at is None:
            raise SchemaError(f"{name}: no column " + ", ".join(columns))


def _elements(stream, tag: str) -> Iterator[ElementTree.Element]:
    """Elements of one name, each dropped once it has been used."""
    parents = []
    for event, element in ElementTree.iterparse(stream, ("start", "end")):
        if event == "start":
            parents.append(element)
            continue
        parents.pop()
        if element.tag == _MAIN + tag:
            yield element
            if parents:
                parents[-1].clear()


def _sheet_member(book: zipfile.ZipFile, sheet: str | None, name: str) -> tuple[str, bool]:
    """Where in the file a sheet lies, and whether the workbook counts days from 1904."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    sheets = {s.get("name"): s.get(_RELATION) for s in root.iter(f"{_MAIN}sheet")}
    if not sheets or (sheet is not None and sheet not in sheets):
        raise SchemaError(f"{name}: no sheet {sheet or ''}".rstrip())
    wanted = next(iter(sheets.values())) if sheet is None else sheets[sheet]
    relations = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in relations if r.get("Id") == wanted)
    settings = root.find(f"{_MAIN}workbookPr")
    from_1904 = settings is not None and settings.get("date1904") in ("1", "true")
    return posixpath.normpath(posixpath.join("/xl", target)).lstrip("/"), from_1904


def _string(element: ElementTree.Element) -> str:
    """Text of a string item, its runs joined, without phonetic hints."""
    parts = [element.find(f"{_MAIN}t"), *element.iterfind(f"{_MAIN}r/{_MAIN}t")]
    return "".join(p.text or "" for p in parts if p is not None)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as stream:
        return [_string(item) for item in _elements(stream, "si")]


def _date_styles(book: zipfile.ZipFile) -> list[bool]:
    """Whether a cell style shows a date or time, by the style's number."""
    if "xl/styles.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {f.get("numFmtId"): _shows_date(f.get("formatCode")) for f in root.iter(f"{_MAIN}numFmt")}
    styles = root.iterfind(f"{_MAIN}cellXfs/{_MAIN}xf")
    return [own.get(n, int(n) in _DATE_FORMATS) for n in (s.get("numFmtId", "0") for s in styles)]


def _shows_date(code: str) -> bool:
    """Whether a number format holds a letter of a date outside quotes, escapes and colours."""
    return re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\\.|_.|\*.|\[(?![hms]+\])[^\]]*\]', "", code.lower())) is not None


def _column(reference: str | None, position: int) -> int:
    """Number of a cell's column; a cell without a reference lies where it stands."""
    if reference is None:
        return position
    number = 0
    for letter in reference.rstrip("0123456789"):
        number = number * 26 + ord(letter) - 64
    return number - 1


def _text(cell: ElementTree.Element, shared: Sequence[str], dated: Sequence[bool], from_1904: bool) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        item = cell.find(f"{_MAIN}is")
        return None if item is None else _string(item) or None
    value = cell.findtext(f"{_MAIN}v")
    if not value or kind == "e":
        return None
    if kind == "s":
        return shared[int(value)] or None
    if kind == "b":
        return "true" if value == "1" else "false"
    if kind == "d":
        return value.replace("T", " ").removesuffix("Z")
    if kind == "n":
        style = int(cell.get("s", 0))
        return _moment(float(value), from_1904) if style < len(dated) and dated[style] else _number(value)
    return value


def _number(value: str) -> str:
    number = float(value)
    return str(int(number)) if number.is_integer() and abs(number) < 1 << 53 else value


def _moment(days: float, from_1904: bool) -> str:
    """A day number as date and time, to the millisecond; the format counts a 29 February 1900 that was not."""
    first = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 31 if days < 60 else 30)
    moment = first + dt.timedelta(milliseconds=round(days * 86_400_000))
    return moment.isoformat(" ", "milliseconds" if moment.microsecond else "seconds")
