"""Daily production sheets: workbooks and delimited files as untyped positional rows."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from functools import cache
from itertools import islice
from typing import IO
from xml.etree import ElementTree
from xml.sax.saxutils import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T, functions as F

from stratawell.config import SHEET_COLUMNS

BATCH_ROWS = 10_000
POSITIONS = [f"_c{i}" for i in range(len(SHEET_COLUMNS))]
SHEET_SCHEMA = T.StructType(
    [T.StructField("source_file", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in POSITIONS]
)


def read_csv_sheet(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Delimited twin of the sheet: 24 text columns, the header row still in the data."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in POSITIONS])
    return (
        spark.read.options(**options)
        .csv(path, schema=schema, header=False)
        .withColumn("source_file", F.col("_metadata.file_path"))
        .select("source_file", *POSITIONS)
    )


def read_workbooks(spark: SparkSession, path: str, sheet: int = 0) -> DataFrame:
    """Spreadsheet files, decoded in parallel over files. A sheet has at most 2^20 rows."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    return decode_workbooks(files.select("path", "content"), sheet)


def decode_workbooks(files: DataFrame, sheet: int = 0) -> DataFrame:
    """(path, content) -> one all-text row per sheet row."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = _sheet_rows(content.as_py(), sheet)
                while rows := list(islice(found, BATCH_ROWS)):
                    columns = [pa.array([path] * len(rows), pa.string()), *(pa.array(c, pa.string()) for c in zip(*rows))]
                    yield pa.RecordBatch.from_arrays(columns, names=SHEET_SCHEMA.names)

    return files.select("path", "content").mapInArrow(decode, SHEET_SCHEMA)


def count_source_files(spark: SparkSession, path: str) -> int:
    """Reachability check: number of files below a path; contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path").count()


# ---- workbook decoding (one file inside a task) -----------------------------------------------

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_BUILT_IN_DATE_FORMATS = {14, 15, 16, 17, 22}


def _part(book: zipfile.ZipFile, name: str):
    return ElementTree.parse(book.open(name)).getroot() if name in book.namelist() else None


def _sheet_path(book: zipfile.ZipFile, index: int) -> str:
    sheets = _part(book, "xl/workbook.xml").find(f"{_MAIN}sheets")
    wanted = sheets[index].get(_REL_ID)
    for rel in _part(book, "xl/_rels/workbook.xml.rels"):
        if rel.get("Id") == wanted:
            return "xl/" + rel.get("Target").removeprefix("/xl/")
    raise ValueError(f"workbook has no sheet {index}")


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell styles that show a number as a date."""
    styles = _part(book, "xl/styles.xml")
    if styles is None:
        return set()
    custom = {
        int(f.get("numFmtId"))
        for f in styles.iter(f"{_MAIN}numFmt")
        if re.search("[dy]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")).lower())
    }
    dates = _BUILT_IN_DATE_FORMATS | custom
    formats = styles.find(f"{_MAIN}cellXfs")
    return {
        i for i, f in enumerate([] if formats is None else formats)
        if int(f.get("numFmtId", 0)) in dates
    }


def _sheet_rows(content: bytes, index: int) -> Iterator[list[str | None]]:
    """The rows of a sheet. Plain ones are cut out of the text; from the first other one on the XML is parsed."""
    book = zipfile.ZipFile(io.BytesIO(content))
    shared_part = _part(book, "xl/sharedStrings.xml")
    shared = (
        [] if shared_part is None
        else ["".join(t.text or "" for t in s.iter(f"{_MAIN}t")) for s in shared_part]
    )
    dates = _date_styles(book)
    name, done = _sheet_path(book, index), 0
    for rows in _plain_pieces(book.open(name), shared, dates):
        if rows is None:
            yield from islice(_parsed_rows(book.open(name), shared, dates), done, None)
        else:
            done += len(rows)
            yield from rows


def _parsed_rows(source: IO[bytes], shared: list[str], dates: set[int]) -> Iterator[list[str | None]]:
    for _, element in ElementTree.iterparse(source):
        if element.tag != f"{_MAIN}row":
            continue
        row: list[str | None] = [None] * len(POSITIONS)
        for at, cell in enumerate(element.iter(f"{_MAIN}c")):
            at = _column(re.match("[A-Z]+", cell.get("r")).group()) if cell.get("r") else at
            if at < len(row):
                row[at] = _text(cell, shared, dates)
        yield row
        element.clear()


# A cell with a reference, empty or with one value: its letters, other attributes and value element.
_CELL = re.compile(r'<c r="([A-Z]+)[0-9]+"([^>/]*)(?:/>|>(<v>[^<]*</v>|<is><t>[^<]*</t></is>)</c>)')
_PIECE = 1 << 20


def _plain_pieces(source: IO[bytes], shared: list[str], dates: set[int]) -> Iterator[list | None]:
    """Lists of rows, about a piece of text each; None, as the last item, if what follows has to be parsed."""
    read = source.read(_PIECE)
    head, start, rest = read.partition(b"<sheetData>")
    encoding = re.search(rb"encoding=.([\w-]+)", head)
    plain = start and f'xmlns="{_MAIN[1:-1]}"'.encode() in head and b"<!" not in head
    if not plain or (encoding and encoding[1].lower() != b"utf-8"):
        yield None
        return
    while read:
        whole, end, rest = rest.rpartition(b"</row>")
        if end:
            rows = _plain_rows((whole + end).decode(), shared, dates)
            yield rows
            if rows is None:
                return
        read = source.read(_PIECE)
        rest += read
    if b"<row" in rest or b"</sheetData>" not in rest:
        yield None


def _plain_rows(text: str, shared: list[str], dates: set[int]) -> list | None:
    """Rows of complete row elements with plain cells only, else None.

    Every tag is accounted for: those of the cells that were found and a pair a row are all there are.
    """
    parts, rows, tags, coded = text.split("</row>")[:-1], [], 0, "&" in text
    if "\r" in text or "&#" in text or text.count("<row") != len(parts):
        return None
    for part in parts:
        row: list[str | None] = [None] * len(POSITIONS)
        for letters, attributes, body in _CELL.findall(part):
            kind, style = _kind(attributes)
            if kind == "inlineStr":
                if body.startswith("<v>"):
                    return None
                value, tags = body[7:-9], tags + (6 if body else 1)
            elif body.startswith("<is>"):
                return None
            else:
                value, tags = body[3:-4] if body else None, tags + (4 if body else 1)
            if coded and value:
                value = unescape(value, {"&quot;": '"', "&apos;": "'"})
            at = _column(letters)
            if at < len(row):
                row[at] = value if kind == "inlineStr" else _shown(value, kind, style, shared, dates)
        rows.append(row)
    return rows if text.count("<") == tags + 2 * len(parts) else None


@cache
def _kind(attributes: str) -> tuple[str | None, int]:
    kind, style = (re.search(rf' {name}="([^"]*)"', attributes) for name in "ts")
    return kind and kind[1], int(style[1]) if style else 0


@cache
def _column(letters: str) -> int:
    n = 0
    for letter in letters:
        n = n * 26 + ord(letter) - 64
    return n - 1


def _text(cell, shared: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    return _shown(cell.findtext(f"{_MAIN}v"), kind, int(cell.get("s", 0)), shared, dates)


def _shown(value: str | None, kind: str | None, style: int, shared: list[str], dates: set[int]) -> str | None:
    if value is None:
        return None
    if kind == "s":
        return shared[int(value)]
    if kind is None and style in dates:
        day = datetime(1899, 12, 30) + timedelta(days=float(value))
        return day.strftime("%d-%b-%y")
    return value
