"""Spreadsheets: rows of zipped XML workbooks, read as streams, all values as strings.

A sheet is parsed row by row, so what is held of it are its shared strings and a batch of
rows. read() takes files from anywhere Spark reads and gives a file to a task;
the data source deals ranges of rows of large sheets to several tasks.
"""

from __future__ import annotations

import io
import re
import zipfile
from array import array
from collections.abc import Iterator
from datetime import datetime, timedelta
from fnmatch import fnmatch
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .registry import HEADER_CELLS

SCHEMA = "source_file string, sheet_name string, sheet int, row long, fields map<string,string>"
_ARROW = pa.schema([("source_file", pa.string()), ("sheet_name", pa.string()), ("sheet", pa.int32()), ("row", pa.int64()), ("fields", pa.map_(pa.string(), pa.string()))])
ROWS = 4096
#: Numbers of built-in formats that show a date or a time.
DATE_FORMATS = {*range(14, 23), *range(45, 48)}
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _tag(e) -> str:
    return e.tag.rpartition("}")[2]


class _Strings:
    """Shared strings as one block of UTF-8 and offsets."""

    def __init__(self, z: zipfile.ZipFile):
        self.data, self.at = bytearray(), array("q", [0])
        if "xl/sharedStrings.xml" not in z.namelist():
            return
        root = None
        for event, e in ElementTree.iterparse(z.open("xl/sharedStrings.xml"), ("start", "end")):
            root = e if root is None else root
            if event == "end" and _tag(e) == "si":
                self.data += _plain(e).encode()
                self.at.append(len(self.data))
                root.clear()

    def __getitem__(self, k: int) -> str:
        return self.data[self.at[k] : self.at[k + 1]].decode()


def _plain(e) -> str:
    """Text of a string item: its runs, without phonetic ones."""
    return "".join(t.text or "" for run in e for t in ([run] if _tag(run) == "t" else run if _tag(run) == "r" else []) if _tag(t) == "t")


def _date_styles(z: zipfile.ZipFile) -> list[bool]:
    if "xl/styles.xml" not in z.namelist():
        return []
    root = ElementTree.parse(z.open("xl/styles.xml")).getroot()
    own = {int(e.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", e.get("formatCode", "")) for e in root.iter() if _tag(e) == "numFmt"}
    dates = DATE_FORMATS | {k for k, f in own.items() if re.search("[dmyhs]", f, re.I)}
    return [int(x.get("numFmtId", 0)) in dates for e in root if _tag(e) == "cellXfs" for x in e]


class Workbook:
    """A workbook's sheets as streams of rows."""

    def __init__(self, file):
        self.zip = zipfile.ZipFile(file)
        book = ElementTree.parse(self.zip.open("xl/workbook.xml")).getroot()
        to = {e.get("Id"): e.get("Target") for e in ElementTree.parse(self.zip.open("xl/_rels/workbook.xml.rels")).getroot()}
        path = lambda t: t[1:] if t.startswith("/") else f"xl/{t}"
        self.sheets = [(e.get("name"), path(to[e.get(_RELATION)])) for e in book.iter() if _tag(e) == "sheet"]
        since_1904 = any(e.get("date1904") in ("1", "true") for e in book.iter() if _tag(e) == "workbookPr")
        self.epoch = datetime(1904, 1, 1) if since_1904 else datetime(1899, 12, 30)
        self.dates = _date_styles(self.zip)
        self._strings = None

    def last_row(self, sheet: int) -> int | None:
        """The last row's number as the sheet tells it."""
        with self.zip.open(self.sheets[sheet][1]) as f:
            m = re.search(rb'<(?:\w+:)?dimension ref="[A-Z]+[0-9]+:[A-Z]+([0-9]+)"', f.read(4096))
        return int(m[1]) if m else None

    def _value(self, c) -> str | None:
        kind = c.get("t", "n")
        if kind == "inlineStr":
            return next((_plain(e) for e in c if _tag(e) == "is"), None)
        v = next((e.text for e in c if _tag(e) == "v"), None)
        if v is None or kind == "e":
            return None
        if kind == "s":
            if self._strings is None:
                self._strings = _Strings(self.zip)
            return self._strings[int(v)]
        if kind == "b":
            return "True" if v == "1" else "False"
        style = int(c.get("s", 0))
        if kind == "n" and style < len(self.dates) and self.dates[style]:
            return str(self.epoch + timedelta(seconds=round(float(v) * 86400)))
        return v

    def rows(self, sheet: int, past: float = float("inf")) -> Iterator[tuple[int, dict[int, str]]]:
        """(number, values by column) of a sheet's rows with a value, before a number."""
        held, at, row = None, 0, 0
        for event, e in ElementTree.iterparse(self.zip.open(self.sheets[sheet][1]), ("start", "end")):
            tag = _tag(e)
            if event == "start":
                held = e if tag == "sheetData" else held
            elif tag == "row":
                row, at, out = int(e.get("r", row + 1)), -1, {}
                if row >= past:
                    return
                for c in e:
                    ref = c.get("r")
                    at = at + 1 if ref is None else column(ref)
                    v = self._value(c)
                    if v not in (None, ""):
                        out[at] = v
                if out:
                    yield row, out
                held.clear()

    def records(self, sheet: int, first: int = 0, past: float = float("inf")) -> Iterator[tuple[int, dict[str, str]]]:
        """(row, values by column name) of the rows below the header, from a row on and before one.

        The first row with a value is the header; columns without a name are called by their
        place. Where half of the columns or more have none and the row below looks like a
        header, that row takes its place.
        """
        rows = self.rows(sheet, past)
        top = next(rows, None)
        if top is None:
            return
        second = next(rows, None)
        width = max(max(top[1]), max(second[1]) if second else 0) + 1
        names = {k: f"Unnamed: {k}" for k in range(width)} | top[1]
        looks = second is not None and sum(any(h in v.lower() for h in HEADER_CELLS) for v in second[1].values()) >= 2
        if looks and 2 * (width - len(top[1])) >= width:
            names |= {k: v.strip() for k, v in second[1].items() if v.strip()}
            second = None
        seen: dict[str, int] = {}
        for k in sorted(names):
            n = seen[names[k]] = seen.get(names[k], -1) + 1
            names[k] = f"{names[k]}.{n}" if n else names[k]
        if second is not None and second[0] >= first:
            yield second[0], {names[k]: v for k, v in second[1].items()}
        for number, values in rows:
            if number >= first:
                yield number, {names.get(k, f"Unnamed: {k}"): v for k, v in values.items()}


def column(ref: str) -> int:
    """Number, from 0, of the column of a cell's reference."""
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = 26 * n + ord(c.upper()) - 64
    return n - 1


def letters(n: int) -> str:
    out = ""
    n += 1
    while n:
        n, k = divmod(n - 1, 26)
        out = chr(65 + k) + out
    return out


def _batches(path: str, book: Workbook, sheet: int, first: int = 0, past: float = float("inf")) -> Iterator[pa.RecordBatch]:
    name, held = book.sheets[sheet][0], []

    def batch() -> pa.RecordBatch:
        n = len(held)
        return pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([name] * n), pa.array([sheet] * n, pa.int32()), pa.array([r for r, _ in held], pa.int64()), pa.array([list(v.items()) for _, v in held], _ARROW.field("fields").type)], schema=_ARROW)

    for r in book.records(sheet, first, past):
        held.append(r)
        if len(held) == ROWS:
            yield batch()
            held = []
    if held:
        yield batch()


def rows(files: DataFrame, sheets: str = "all") -> DataFrame:
    """Rows of workbooks (path, content), as Spark's binaryFile gives them, of any number.

    (source_file, sheet_name, sheet, row, fields): fields has a row's values by the names of
    the header above them. sheets: "all", or "first" of each file. What isn't a workbook has
    one row, whose sheet is -1 and whose fields tell the error. A file is one task's work
    and is streamed: its bytes, its shared strings and a batch of rows are in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                try:
                    book = Workbook(io.BytesIO(content.as_buffer() if content.is_valid else b""))
                    for k in range(len(book.sheets) if sheets == "all" else min(1, len(book.sheets))):
                        yield from _batches(path, book, k)
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, ValueError, IndexError) as e:
                    yield pa.RecordBatch.from_pylist([{"source_file": path, "sheet_name": None, "sheet": -1, "row": None, "fields": [("error", f"{type(e).__name__}: {e}")]}], _ARROW)

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def read(spark: SparkSession, path: str, sheets: str = "all") -> DataFrame:
    """rows() of the workbooks at a path or glob, from any store that Spark reads."""
    return rows(spark.read.format("binaryFile").load(path), sheets)


def named(table: DataFrame, columns: list[str]) -> DataFrame:
    """rows() with some fields as columns; null where a sheet doesn't have them."""
    return table.where("sheet >= 0").select("source_file", "sheet_name", "row", *(F.try_element_at("fields", F.lit(c)).alias(c) for c in columns))


def _store(path: str):
    """(file system, path in it) of a local path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:/", path) else (fs.LocalFileSystem(), path)


def _files(path: str) -> list[str]:
    from pyarrow import fs

    store, at = _store(path)
    head, _, last = at.rpartition("/")
    if any(c in last for c in "*?["):
        return sorted(f.path for f in store.get_file_info(fs.FileSelector(head)) if f.type == fs.FileType.File and fnmatch(f.base_name, last))
    info = store.get_file_info(at)
    if info.type == fs.FileType.Directory:
        return sorted(f.path for f in store.get_file_info(fs.FileSelector(at)) if f.type == fs.FileType.File)
    return [at]


class _Range(InputPartition):
    def __init__(self, path: str, sheet: int, first: int, past: float):
        self.path, self.sheet, self.first, self.past = path, sheet, first, past


class _Reader(DataSourceReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def partitions(self) -> list[_Range]:
        store, out = _store(self.path)[0], []
        for f in _files(self.path):
            with store.open_input_file(f) as file:
                book = Workbook(file)
                for k in range(len(book.sheets)):
                    edges = [0, *range(self.size, book.last_row(k) or 0, self.size), float("inf")]
                    out += [_Range(f, k, a, b) for a, b in zip(edges, edges[1:])]
        return out

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        with _store(self.path)[0].open_input_file(partition.path) as file:
            yield from _batches(partition.path, Workbook(file), partition.sheet, partition.first, partition.past)


class WorkbookSource(DataSource):
    """spark.read.format("workbook").load(path): rows() by ranges of rows.

    Each range of rowsPerTask (50,000) rows of a sheet is a task, which inflates the sheet up
    to its end and keeps only its rows. Paths are local ones that all executors have, or
    URIs that Arrow's file systems open.
    """

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], int(self.options.get("rowsPerTask", 50_000)))


def to_bytes(sheets: dict[str, list[list]]) -> bytes:
    """A workbook of sheets, lists of rows; None is no cell, numbers are numbers."""
    out = io.BytesIO()
    names = list(sheets)
    office = "http://schemas.openxmlformats.org"
    main, relations = f'xmlns="{office}/spreadsheetml/2006/main"', f"{office}/officeDocument/2006/relationships"
    quote = lambda s: escape(s, {'"': "&quot;"})
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        part = "".join(f'<Override PartName="/xl/worksheets/sheet{k + 1}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(len(names)))
        z.writestr("[Content_Types].xml", f'<Types xmlns="{office}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{part}</Types>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{office}/package/2006/relationships"><Relationship Id="rId1" Type="{relations}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{quote(s)}" sheetId="{k + 1}" r:id="rId{k + 1}"/>' for k, s in enumerate(names))
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{relations}"><sheets>{listed}</sheets></workbook>')
        linked = "".join(f'<Relationship Id="rId{k + 1}" Type="{relations}/worksheet" Target="worksheets/sheet{k + 1}.xml"/>' for k in range(len(names)))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{office}/package/2006/relationships">{linked}</Relationships>')
        for k, name in enumerate(names):
            width = max((len(r) for r in sheets[name]), default=1)
            with z.open(f"xl/worksheets/sheet{k + 1}.xml", "w") as f:
                f.write(f'<worksheet {main}><dimension ref="A1:{letters(max(width, 1) - 1)}{max(1, len(sheets[name]))}"/><sheetData>'.encode())
                for i, r in enumerate(sheets[name], 1):
                    cells = "".join(_cell(f"{letters(j)}{i}", v) for j, v in enumerate(r) if v is not None)
                    f.write(f'<row r="{i}">{cells}</row>'.encode())
                f.write(b"</sheetData></worksheet>")
    return out.getvalue()


def _cell(ref: str, v) -> str:
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)):
        return f'<c r="{ref}"><v>{v!r}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'
