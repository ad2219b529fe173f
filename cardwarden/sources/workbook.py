"""Workbook (.xlsx) drops: each workbook is read by one task, as a stream of rows.

A folder of workbooks is the unit of parallelism. Spark packs the files into tasks by
size (spark.sql.files.maxPartitionBytes), which also bounds what one task holds.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

_ROWS_PER_FRAME = 10_000
_REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# Built-in number formats of the file format that show a day.
_DAY_FORMATS = {14, 15, 16, 17, 22}


def read_workbooks(
    spark: SparkSession, paths: str | Sequence[str], sheet: str, columns: Sequence[str]
) -> DataFrame:
    """All rows of one sheet, columns by position and as text, header row dropped.

    Blank rows are skipped. A row with a value beyond the last column fails the query.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return workbook_rows(files, sheet, columns)


def workbook_rows(files: DataFrame, sheet: str, columns: Sequence[str]) -> DataFrame:
    """The same for any frame with `path` and `content` columns."""
    names = list(columns)
    width = len(names)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                block: list[list] = []
                for row in sheet_rows(content, sheet):
                    if any(value is not None for value in row[width:]):
                        raise ValueError(f"{path}: a row of sheet {sheet!r} has more than {width} columns: {row}")
                    if any(value is not None for value in row):
                        block.append((row + [None] * width)[:width] + [path])
                    if len(block) == _ROWS_PER_FRAME:
                        yield pd.DataFrame(block, columns=[*names, "source_file"])
                        block = []
                yield pd.DataFrame(block, columns=[*names, "source_file"])

    schema = ", ".join(f"{name} string" for name in [*names, "source_file"])
    return files.select("path", "content").mapInPandas(read, schema)


def sheet_rows(content: bytes, sheet: str) -> Iterator[list[str | None]]:
    """Rows of one sheet below its header, as text; days as ISO text."""
    with zipfile.ZipFile(io.BytesIO(bytes(content))) as book:
        part, epoch = _locate(book, sheet)
        shared = _shared_strings(book)
        day_styles = _day_styles(book)
        with book.open(part) as xml:
            rows = _elements(xml, "row")
            next(rows, None)
            for row in rows:
                values: list[str | None] = []
                for cell in row:
                    at = _column(cell.get("r"), len(values))
                    values.extend([None] * (at - len(values)))
                    values.append(_value(cell, shared, day_styles, epoch))
                yield values


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _elements(xml, tag: str) -> Iterator[ElementTree.Element]:
    """Finished elements of one kind; their parent is emptied so memory stays flat."""
    path = []
    for event, node in ElementTree.iterparse(xml, events=("start", "end")):
        if event == "start":
            path.append(node)
            continue
        path.pop()
        if _local(node.tag) == tag:
            yield node
            if path:
                path[-1].clear()


def _text(node: ElementTree.Element) -> str:
    """Text of a string item, without the phonetic hints some editors add."""
    if _local(node.tag) == "rPh":
        return ""
    own = (node.text or "") if _local(node.tag) == "t" else ""
    return own + "".join(_text(child) for child in node)


def _locate(book: zipfile.ZipFile, sheet: str) -> tuple[str, datetime]:
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    targets = {link.get("Id"): link.get("Target") for link in links}
    epoch = datetime(1899, 12, 30)
    for node in root.iter():
        if _local(node.tag) == "workbookPr" and node.get("date1904") in ("1", "true"):
            epoch = datetime(1904, 1, 1)
    for node in root.iter():
        if _local(node.tag) == "sheet" and node.get("name") == sheet:
            target = targets[node.get(_REL_ID)]
            return (target[1:] if target.startswith("/") else f"xl/{target}"), epoch
    raise ValueError(f"workbook has no sheet named {sheet!r}")


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as xml:
        return [_text(item) for item in _elements(xml, "si")]


def _day_styles(book: zipfile.ZipFile) -> set[int]:
    """Positions of the cell styles that show a number as a day."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    day_formats = set(_DAY_FORMATS)
    styles: list[int] = []
    for node in root.iter():
        if _local(node.tag) == "numFmt":
            code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", node.get("formatCode", "")).lower()
            if "y" in code or "d" in code:
                day_formats.add(int(node.get("numFmtId")))
        elif _local(node.tag) == "cellXfs":
            styles = [int(style.get("numFmtId", 0)) for style in node]
    return {at for at, number_format in enumerate(styles) if number_format in day_formats}


def _column(reference: str | None, following: int) -> int:
    """Zero-based column of a cell reference such as `C7`; unnamed cells just follow on."""
    if not reference:
        return following
    at = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        at = at * 26 + ord(letter) - 64
    return at - 1


def _value(cell, shared: list[str], day_styles: set[int], epoch: datetime) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return next((_text(node) for node in cell if _local(node.tag) == "is"), None)
    raw = next((node.text for node in cell if _local(node.tag) == "v"), None)
    if raw is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(raw)]
    if kind == "n" and int(cell.get("s", 0)) in day_styles:
        return (epoch + timedelta(days=float(raw))).strftime("%Y-%m-%d %H:%M:%S")
    return raw
