"""Minimal workbooks made from rows, to have something to read back."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from datetime import date
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame

_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_DAY_STYLE = (
    f'<styleSheet {_MAIN}><numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/>'
    '</numFmts><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>'
)


def workbook_bytes(sheet: str, header: Sequence[str], rows: Iterable[Sequence]) -> bytes:
    """A workbook with an empty cover sheet and one data sheet.

    Text goes through the shared strings, days become styled serial numbers, and None leaves
    the cell out, as spreadsheet programs write them.
    """
    strings: dict[str, int] = {}
    lines = []
    for at, row in enumerate([header, *rows], start=1):
        cells = []
        for column, value in enumerate(row):
            name = f"{chr(65 + column)}{at}"
            if isinstance(value, date):
                serial = (value - date(1899, 12, 30)).days
                cells.append(f'<c r="{name}" s="1"><v>{serial}</v></c>')
            elif value is not None:
                index = strings.setdefault(value, len(strings))
                cells.append(f'<c r="{name}" t="s"><v>{index}</v></c>')
        lines.append(f'<row r="{at}">{"".join(cells)}</row>')
    items = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in strings)
    parts = {
        "xl/workbook.xml": f'<workbook {_MAIN} xmlns:r="{_REL}"><sheets>'
        '<sheet name="cover" sheetId="1" r:id="rId1"/>'
        f'<sheet name="{escape(sheet)}" sheetId="2" r:id="rId2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/'
        'package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
        '<Relationship Id="rId2" Target="worksheets/sheet2.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f"<worksheet {_MAIN}><sheetData/></worksheet>",
        "xl/worksheets/sheet2.xml": f"<worksheet {_MAIN}><sheetData>{''.join(lines)}"
        "</sheetData></worksheet>",
        "xl/sharedStrings.xml": f"<sst {_MAIN}>{items}</sst>",
        "xl/styles.xml": _DAY_STYLE,
    }
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        for path, content in parts.items():
            book.writestr(path, content)
    return buffer.getvalue()


def as_workbooks(rows: DataFrame, sheet: str) -> DataFrame:
    """Rows packed into workbooks, one per Arrow batch: (path, content), no shuffle."""
    header = rows.columns

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = frame.astype(object).where(frame.notna(), None).values.tolist()
            book = workbook_bytes(sheet, header, values)
            yield pd.DataFrame({"path": [f"{sheet}.xlsx"], "content": [book]})

    return rows.mapInPandas(pack, "path string, content binary")
