"""Sheets of plain cells are cut out of their text; others are parsed from the first odd piece on."""

import zipfile

import pyarrow as pa
import pytest

from stratawell.registry.files import book, row_elements, workbook
from stratawell.sources import production

ROWS = [["a<b & 'c'", "", None, " x ", *[None] * 19, "last"]] * 30_000


def rows_of(content):
    return list(production._sheet_rows(content, 0))


def test_plain_sheet_is_not_parsed(monkeypatch):
    expected = [list(r) for r in production._parsed_rows(sheet_of(workbook(ROWS)), [], set())]
    monkeypatch.setattr(production, "_parsed_rows", lambda *a: pytest.fail("parsed"))
    assert rows_of(workbook(ROWS)) == expected == ROWS


def sheet_of(content):
    import io

    return zipfile.ZipFile(io.BytesIO(content)).open("xl/worksheets/sheet1.xml")


def test_batch_of_rows_gives_the_same_sheet():
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*ROWS)], names=[str(i) for i in range(24)])
    assert sheet_of(book(row_elements(batch))).read() == sheet_of(workbook(ROWS)).read()


@pytest.mark.parametrize(
    "odd",
    [
        '<row r="9"><c r="A9" t="inlineStr"><is><r><t>x</t></r><r><t>y</t></r></is></c></row>',
        '<row r="9"/>',
        '<row r="9"><c t="inlineStr"><is><t>no reference</t></is></c></row>',
        '<!-- </row> --><row r="9"><c r="B9"><f>1+1</f><v>2</v></c></row>',
        '<row r="9"><c r="A9" t="inlineStr"><is><t><![CDATA[<row></row>]]></t></is></c></row>',
        '<row r="9"><c r="C9" t="str"><v>&#65;\r\n</v></c><c r="AA9"><v>1</v></c></row>',
        '<row r="9"><c r="A9"/><c r="B9"><v>7</v></c><c r="C9" t="inlineStr"><is><t/></is></c></row>',
    ],
)
def test_odd_rows_come_out_as_parsed(odd):
    many = '<row r="1"><c r="A1"><v>1.5</v></c></row>' * 40_000
    content = book((many + odd + many).encode())
    expected = [list(r) for r in production._parsed_rows(sheet_of(content), [], set())]
    assert len(expected) == 80_001
    assert rows_of(content) == expected
