"""Sheets of workbooks (Office Open XML) as a Spark data source: format "workbook".

Options: path, sheet (its name), header (the row of its column names, from 0), rows (of one partition; ROWS if not
given). A partition is a range of rows. Its task reads the sheet's part as a stream and keeps its own rows only; then it reads
the shared texts as a stream and keeps those that its rows name. So no task holds more than its rows, and nothing
but the header is read on the driver.

All values are text, as the sheet shows them without rounding: whole numbers without a point, booleans as True and
False, dates as YYYY-MM-DD HH:MM:SS. Empty cells and errors are null; rows without any value are left out, and so are
cells to the right of the last named column. A column without a name is "Unnamed: i"; a name that is there already,
in whatever case, gets .1, .2 and so on.
"""

from __future__ import annotations

import datetime
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sieveline.session import workers_find_package

FORMAT = "workbook"
ROWS = 50_000
#: Numbers of the built-in formats that show dates or times.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
STRICT_RELATION = "{http://purl.oclc.org/ooxml/officeDocument/relationships}id"


def _local(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _open(path: str) -> zipfile.ZipFile:
    """The zip parts of a file at a path, or at a URI of a file system that pyarrow knows."""
    if not path.lower().endswith(".xlsx"):
        raise ValueError(f"only workbooks of the kind .xlsx can be read: {path}")
    if "://" in path or path.startswith("file:"):
        from pyarrow import fs

        files, where = fs.FileSystem.from_uri(path if "://" in path else f"file://{path[5:]}")
        return zipfile.ZipFile(files.open_input_file(where))
    return zipfile.ZipFile(path)


def _part(book: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    """A small part, whole."""
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _targets(book: zipfile.ZipFile) -> dict[str, tuple[str, str]]:
    """Relations of the workbook: id to (kind, part)."""
    found = _part(book, "xl/_rels/workbook.xml.rels")
    near = lambda to: to.lstrip("/") if to.startswith("/") else posixpath.normpath(f"xl/{to}")
    return {x.get("Id"): (x.get("Type", "").rpartition("/")[2], near(x.get("Target", ""))) for x in found} if found is not None else {}


def _sheets(book: zipfile.ZipFile) -> dict[str, str]:
    """Names of worksheets and their parts, in the workbook's order."""
    targets, found = _targets(book), {}
    for x in _part(book, "xl/workbook.xml").iter():
        if _local(x) == "sheet":
            kind, part = targets.get(x.get(RELATION) or x.get(STRICT_RELATION), ("", ""))
            if kind == "worksheet":
                found[x.get("name")] = part
    return found


def sheet_names(path: str) -> list[str]:
    with _open(path) as book:
        return list(_sheets(book))


def _texts_part(book: zipfile.ZipFile) -> str | None:
    return next((part for kind, part in _targets(book).values() if kind == "sharedStrings"), None)


def _date_styles(book: zipfile.ZipFile) -> tuple[set[int], datetime.datetime]:
    """Which cell styles show dates, and the day that dates are counted from."""
    styles = next((_part(book, part) for kind, part in _targets(book).values() if kind == "styles"), None)
    dates, told = set(), set(DATE_FORMATS)
    for x in styles if styles is not None else ():
        if _local(x) == "numFmts":
            bare = lambda code: re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", code)
            told |= {int(f.get("numFmtId")) for f in x if re.search("[ymdhs]", bare(f.get("formatCode", "")), re.IGNORECASE)}
        elif _local(x) == "cellXfs":
            dates = {i for i, f in enumerate(x) if int(f.get("numFmtId", 0)) in told}
    since_1904 = any(_local(x) == "workbookPr" and x.get("date1904") in ("1", "true") for x in _part(book, "xl/workbook.xml"))
    return dates, datetime.datetime(1904, 1, 1) if since_1904 else datetime.datetime(1899, 12, 30)


def _text_of(element: ElementTree.Element) -> str:
    """The text of a plain or rich string, without its reading aids."""
    return "".join(x.text or "" for y in element if _local(y) in ("t", "r") for x in y.iter() if _local(x) == "t")


def _column(reference: str) -> int:
    """The column of a cell's reference such as AB12, from 0."""
    found = 0
    for sign in reference:
        if not sign.isalpha():
            break
        found = found * 26 + ord(sign.upper()) - 64
    return found - 1


def _rows(book: zipfile.ZipFile, part: str, start: int, end: int | None) -> Iterator[tuple[int, list[tuple[int, str, str, int]]]]:
    """Rows from start until before end: number from 0, and its cells: column, kind, raw value, style."""
    with book.open(part) as stream:
        above, number = None, -1
        for event, x in ElementTree.iterparse(stream, events=("start", "end")):
            name = _local(x)
            if event == "start":
                above = x if name == "sheetData" else above
                continue
            if name == "sheetData":
                return
            if name != "row":
                continue
            number = int(x.get("r")) - 1 if x.get("r") else number + 1
            if end is not None and number >= end:
                return
            if number >= start:
                yield number, list(_cells(x))
            above.clear()  # rows that have been read are let go


def _cells(row: ElementTree.Element) -> Iterator[tuple[int, str, str, int]]:
    at = -1
    for cell in row:
        if _local(cell) != "c":
            continue
        at = _column(cell.get("r")) if cell.get("r") else at + 1
        kind = cell.get("t", "n")
        for x in cell:
            if _local(x) == "is":
                yield at, "str", _text_of(x), 0
            elif _local(x) == "v" and x.text:
                yield at, kind, x.text, int(cell.get("s", 0))


def _shared(book: zipfile.ZipFile, wanted: set[int]) -> dict[int, str]:
    """Shared texts of the numbers that are wanted, of a part that is read as a stream."""
    part, found = _texts_part(book), {}
    if part is None or not wanted:
        return found
    with book.open(part) as stream:
        above, number = None, -1
        for event, x in ElementTree.iterparse(stream, events=("start", "end")):
            if event == "start":
                above = x if above is None else above
            elif _local(x) == "si":
                number += 1
                if number in wanted:
                    found[number] = _text_of(x)
                    if len(found) == len(wanted):
                        break
                above.clear()
    return found


def _shown(kind: str, raw: str, style: int, texts: dict[int, str], dates: set[int], since: datetime.datetime) -> str | None:
    """A cell's value as text, null for errors and empty texts."""
    if kind == "s":
        return texts.get(int(raw)) or None
    if kind == "b":
        return "True" if raw == "1" else "False"
    if kind == "e":
        return None
    if kind == "n":
        value = float(raw)
        if style in dates:
            try:
                return str((since + datetime.timedelta(seconds=round(value * 86_400))).replace(microsecond=0))
            except OverflowError:
                return repr(value)
        return str(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)
    return raw or None  # texts of formulas, inline texts, dates in ISO form


def _read(book: zipfile.ZipFile, part: str, start: int, end: int | None, width: int | None, batch: int) -> Iterator[list[str | None]]:
    """Rows as lists of text; at most batch rows are held at a time."""
    dates, since = _date_styles(book)

    def told(held: list) -> Iterator[list[str | None]]:
        texts = _shared(book, {int(raw) for cells in held for _, kind, raw, _ in cells if kind == "s"})
        for cells in held:
            row: list[str | None] = [None] * (width if width is not None else max((c[0] for c in cells), default=-1) + 1)
            for at, kind, raw, style in cells:
                if at < len(row):
                    row[at] = _shown(kind, raw, style, texts, dates, since)
            if any(x is not None for x in row):
                yield row

    held: list = []
    for _, cells in _rows(book, part, start, end):
        held.append(cells)
        if len(held) >= batch:
            yield from told(held)
            held = []
    yield from told(held)


def _names(header: list[str | None]) -> list[str]:
    """Names of columns, all different in lower case too."""
    names: list[str] = []
    taken: set[str] = set()
    for i, x in enumerate(header):
        name = first = x if x and x.strip() else f"Unnamed: {i}"
        again = 0
        while name.lower() in taken:
            again += 1
            name = f"{first}.{again}"
        taken.add(name.lower())
        names.append(name)
    return names


def _last_row(book: zipfile.ZipFile, part: str) -> int:
    """The number of rows that a sheet says it has; 0 where it doesn't."""
    with book.open(part) as stream:
        for _, x in ElementTree.iterparse(stream, events=("start",)):
            if _local(x) == "dimension":
                digits = re.search(r"(\d+)$", x.get("ref", ""))
                return int(digits[1]) if digits else 0
            if _local(x) == "sheetData":
                break
    return 0


class RowRange(InputPartition):
    """Rows from start until before end; the last range has no end, as a sheet may be longer than it says."""

    def __init__(self, start: int, end: int | None):
        self.start, self.end = start, end


class WorkbookReader(DataSourceReader):
    def __init__(self, path: str, sheet: str, header: int, rows: int, width: int):
        self.path, self.sheet, self.header, self.rows, self.width = path, sheet, header, rows, width

    def partitions(self) -> list[RowRange]:
        with _open(self.path) as book:
            last = _last_row(book, _sheets(book)[self.sheet])
        starts = list(range(self.header + 1, max(last, self.header + 2), self.rows))
        return [RowRange(a, b) for a, b in zip(starts, [*starts[1:], None])]

    def read(self, partition: RowRange) -> Iterator[tuple]:
        with _open(self.path) as book:
            for row in _read(book, _sheets(book)[self.sheet], partition.start, partition.end, self.width, self.rows):
                yield tuple(row)


class Workbook(DataSource):
    """One sheet of a workbook, in ranges of rows."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _told(self) -> tuple[str, str, int]:
        path, header = self.options["path"], int(self.options.get("header", 0))
        return path, self.options.get("sheet") or sheet_names(path)[0], header

    def schema(self) -> T.StructType:
        path, sheet, header = self._told()
        with _open(path) as book:
            parts = _sheets(book)
            if sheet not in parts:
                raise ValueError(f"no sheet {sheet}")
            first = next(_read(book, parts[sheet], header, header + 1, None, 1), [])
        if not first:
            raise ValueError(f"sheet {sheet} has no names in row {header}")
        return T.StructType([T.StructField(x, T.StringType()) for x in _names(first)])

    def reader(self, schema: T.StructType) -> WorkbookReader:
        return WorkbookReader(*self._told(), int(self.options.get("rows", ROWS)), len(schema))


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    workers_find_package(spark)
    spark.dataSource.register(Workbook)
