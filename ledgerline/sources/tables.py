"""Tables of HTML pages as cells of a grid: table, row, column, with nesting and spans.

A page is read once, tag by tag, with a stack of the open tables. A cell takes the next free column of its
row; with rowspan and colspan it covers a rectangle, and later rows flow around it (a rowspan of 0 reaches to the
end of the row group, none reaches further). A nested table is a table of its own, with the outer one as
parent; its text is not the outer cell's. End tags may be missing, as HTML allows.

Pages are parsed where they lie, batch by batch; a page is one row's work.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Widest and highest span, as browsers hold it.
MOST_COLUMNS, MOST_ROWS = 1000, 65_534

_CELL = [T.StructField(c, T.IntegerType()) for c in ("table_no", "parent", "row_no", "col_no", "rowspan", "colspan")] + [T.StructField("header", T.BooleanType()), T.StructField("text", T.StringType())]
_PAGE = [T.StructField(c, T.IntegerType()) for c in ("tables", "rows", "columns", "scripts")]


class _Cell:
    def __init__(self, row: int, col: int, rows: int, cols: int, header: bool):
        self.row, self.col, self.rows, self.cols, self.header = row, col, rows, cols, header
        self.text: list[str] = []


class _Table:
    """One table while it is open. taken: columns that cells of earlier rows cover, and up to which row (exclusive)."""

    def __init__(self, no: int, parent: int | None):
        self.no, self.parent = no, parent
        self.cells: list[_Cell] = []
        self.row, self.col = -1, 0
        self.in_row, self.cell = False, None
        self.taken: dict[int, int] = {}
        self.group_first = 0  # of self.cells

    def end_row(self) -> None:
        self.cell, self.in_row = None, False

    def begin_row(self) -> None:
        self.end_row()
        self.row, self.col, self.in_row = self.row + 1, 0, True

    def begin_group(self) -> None:
        """No cell reaches over the end of its row group."""
        self.end_row()
        for c in self.cells[self.group_first :]:
            c.rows = min(c.rows, self.row + 1 - c.row)
        self.group_first, self.taken = len(self.cells), {}

    def begin_cell(self, rows: int, cols: int, header: bool) -> None:
        if not self.in_row:
            self.begin_row()
        while self.taken.get(self.col, 0) > self.row:
            self.col += 1
        self.cell = _Cell(self.row, self.col, rows, cols, header)
        self.cells.append(self.cell)
        if rows > 1:
            for c in range(self.col, self.col + cols):
                self.taken[c] = self.row + rows
        self.col += cols


def _span(attributes: list, name: str, most: int, zero: int) -> int:
    value = next((v for n, v in attributes if n == name), None) or "1"
    n = int(value) if value.strip().isascii() and value.strip().isdigit() else 1
    return min(n, most) if n else zero


class PageTables(HTMLParser):
    """The tables of one page, in the order in which they open, and how many scripts it has."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[_Table] = []
        self._open: list[_Table] = []
        self._quiet = 0
        self.scripts = 0

    def handle_starttag(self, tag: str, attributes: list) -> None:
        self.scripts += tag == "script"
        if tag in ("script", "style"):
            self._quiet += 1
        elif tag == "table":
            table = _Table(len(self.tables), self._open[-1].no if self._open else None)
            self.tables.append(table)
            self._open.append(table)
        elif self._open:
            table = self._open[-1]
            if tag == "tr":
                table.begin_row()
            elif tag in ("td", "th"):
                table.begin_cell(_span(attributes, "rowspan", MOST_ROWS, MOST_ROWS), _span(attributes, "colspan", MOST_COLUMNS, 1), tag == "th")
            elif tag in ("thead", "tbody", "tfoot"):
                table.begin_group()
            elif tag in ("br", "p", "div", "li"):
                self.handle_data(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self._quiet = max(0, self._quiet - 1)
        elif self._open:
            table = self._open[-1]
            if tag == "table":
                table.begin_group()
                self._open.pop()
            elif tag == "tr":
                table.end_row()
            elif tag in ("td", "th"):
                table.cell = None
            elif tag in ("thead", "tbody", "tfoot"):
                table.begin_group()
            elif tag in ("p", "div", "li"):
                self.handle_data(" ")

    def handle_data(self, data: str) -> None:
        if not self._quiet and self._open and self._open[-1].cell is not None:
            self._open[-1].cell.text.append(data)

    def close(self) -> None:
        super().close()
        while self._open:
            self._open.pop().begin_group()

    @classmethod
    def of(cls, html: str | None) -> PageTables:
        page = cls()
        page.feed(html or "")
        page.close()
        return page


def _text(cell: _Cell) -> str:
    return " ".join("".join(cell.text).split())


def _mapped(pages: DataFrame, key: str, html: str, fields: list[T.StructField], rows) -> DataFrame:
    """key and the rows that `rows` makes of each page."""
    schema = T.StructType([pages.schema[key], *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # a page at a time: one may have very many cells
                made = list(rows(PageTables.of(batch.column(1)[k].as_py())))
                if made:
                    columns = [pa.array([batch.column(0)[k].as_py()] * len(made), arrow[0].type), *(pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), list(arrow)[1:], strict=True))]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return pages.select(key, F.col(html).alias("_html")).mapInArrow(run, schema)


def table_cells(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, table_no, parent (the table in which this one is nested, or NULL), row_no, col_no, rowspan, colspan, header
    and text of every cell. Numbers start at 0; text is without markup, with single spaces."""

    def rows(page: PageTables):
        return ((t.no, t.parent, c.row, c.col, c.rows, c.cols, c.header, _text(c)) for t in page.tables for c in t.cells)

    return _mapped(pages, key, html, _CELL, rows)


def table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, row_no (over all tables of the page, each table's after the other), table_no and cells: the texts of the grid's row,
    spanning cells repeated, NULL where no cell is."""

    def rows(page: PageTables):
        n = 0
        for t in page.tables:
            grid: list[dict[int, str]] = [{} for _ in range(t.row + 1)]
            for c in t.cells:
                for line in grid[c.row : c.row + c.rows]:
                    for col in range(c.col, c.col + c.cols):
                        line.setdefault(col, _text(c))
            for line in grid:
                yield n, t.no, [line.get(col) for col in range(max(line, default=-1) + 1)]
                n += 1

    return _mapped(pages, key, html, [T.StructField("row_no", T.IntegerType()), T.StructField("table_no", T.IntegerType()), T.StructField("cells", T.ArrayType(T.StringType()))], rows)


def page_structure(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, tables, rows, columns (the most that a table's first row has) and scripts of every page."""

    def rows(page: PageTables):
        first = [sum(c.cols for c in t.cells if c.row == 0) for t in page.tables]
        yield len(page.tables), sum(t.row + 1 for t in page.tables), max(first, default=0), page.scripts

    return _mapped(pages, key, html, _PAGE, rows)
