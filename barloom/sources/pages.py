"""Tables of HTML pages as rows of cells.

Only parsing a page needs Python; it runs on Arrow batches and emits rows. Choosing tables,
matching headers and zipping records are DataFrame expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.clean import keep_wellformed_rows

_ROW = "struct<row_no: int, section: string, n_data: int, cells: array<string>, is_data: array<boolean>>"
_SCHEMA = f"page_id bigint, tables array<array<{_ROW}>>"
_ARROW_ROW = pa.struct(
    [
        ("row_no", pa.int32()),
        ("section", pa.string()),
        ("n_data", pa.int32()),
        ("cells", pa.list_(pa.string())),
        ("is_data", pa.list_(pa.bool_())),
    ]
)
#: The td cells of a row ``r``.
_DATA = "filter(r.cells, (c, i) -> get(r.is_data, i))"
_NONE = "no data found|no record found"
_TAGS = frozenset(("table", "thead", "tbody", "tfoot", "tr", "td", "th"))
#: Elements whose content a parser may read as something else than markup.
_RAW = frozenset(
    ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext", "svg", "math")
)
_SPACE = r"[\t\n\r\f ]"
_ATTRIBUTE = rf"""{_SPACE}+[a-zA-Z_][\w:.-]*(?:{_SPACE}*={_SPACE}*(?:"[^"<>]*"|'[^'<>]*'|[\w#%.,:;-]+))?"""
#: A token of plain markup, its text, the names of an end and of a start tag, and the mark of a closed one.
_TOKEN = re.compile(
    rf"(([^<]+)|</([a-zA-Z][a-zA-Z0-9]*){_SPACE}*>|<([a-zA-Z][a-zA-Z0-9]*)(?:{_ATTRIBUTE})*(?:{_SPACE}*|{_SPACE}+(/))>"
    r"|<!--[\w ]+-->|<![dD][oO][cC][tT][yY][pP][eE][\w ]*>)",
    re.ASCII,
)


class _Table:
    """An open table: its rows, and the section, row and cell that are open in it."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, list]] = []
        self.section = ""
        self.row: list[tuple[list[str], bool]] | None = None
        self.cell: list[str] | None = None


class _Builder:
    """Collects the tables of a page as lists of rows.

    A row has its number in the table, its section (thead, tbody, tfoot or none), the number of its
    td cells, its cell texts, and which of the cells are td. A table inside a cell is a table of its
    own, and its rows, cells and texts belong to the outer table, row and cell as well.
    """

    def __init__(self) -> None:
        self.tables: list[_Table] = []
        self.open: list[_Table] = []

    def start(self, tag: str) -> None:
        if tag == "table":
            self.open.append(_Table())
            self.tables.append(self.open[-1])
        elif not self.open:
            return
        elif tag in ("thead", "tbody", "tfoot"):
            self._end_row()
            self.open[-1].section = tag
        elif tag == "tr":
            self._end_row()
            self.open[-1].row = row = []
            for table in self.open:
                table.rows.append((table.section, row))
        elif tag in ("td", "th") and self.open[-1].row is not None:
            self.open[-1].cell = cell = []
            for table in self.open:
                if table.row is not None:
                    table.row.append((cell, tag == "td"))

    def end(self, tag: str) -> None:
        if not self.open:
            return
        if tag in ("td", "th"):
            self.open[-1].cell = None
        elif tag == "tr":
            self._end_row()
        elif tag in ("thead", "tbody", "tfoot"):
            self._end_row()
            self.open[-1].section = ""
        elif tag == "table":
            self.open.pop()

    def data(self, data: str) -> None:
        for table in self.open:
            if table.cell is not None:
                table.cell.append(data)

    def _end_row(self) -> None:
        self.open[-1].row = self.open[-1].cell = None


class _Parser(HTMLParser):
    """Hands the tags and texts of any page to a builder."""

    def __init__(self, builder: _Builder) -> None:
        super().__init__(convert_charrefs=True)
        self.builder = builder

    def handle_starttag(self, tag, attrs):
        self.builder.start(tag)

    def handle_endtag(self, tag):
        self.builder.end(tag)

    def handle_data(self, data):
        self.builder.data(data)


def _plain_tokens(html: str) -> list[tuple[str, ...]] | None:
    """The texts and tags of a page of plain markup; None for any other page.

    Plain are texts, tags with well-formed attributes, comments and document types; elements whose
    content is no markup, and whatever a parser has to mend, are not.
    """
    tokens = _TOKEN.findall(html)
    if sum([len(t[0]) for t in tokens]) != len(html) or not _RAW.isdisjoint([t[3].lower() for t in tokens]):
        return None
    return tokens


def _tables(html: str) -> list[_Table]:
    builder = _Builder()
    tokens = _plain_tokens(html)
    if tokens is None:
        parser = _Parser(builder)
        parser.feed(html)
        parser.close()
        return builder.tables
    for _, text, end, start, closed in tokens:
        if text:
            if builder.open:
                builder.data(unescape(text) if "&" in text else text)
        elif start:
            tag = start.lower()
            if tag in _TAGS:
                builder.start(tag)
                if closed:
                    builder.end(tag)
        elif end:
            tag = end.lower()
            if tag in _TAGS:
                builder.end(tag)
    return builder.tables


def _rows_array(pages: list[list[_Table]], tight: bool) -> pa.Array:
    """The tables of pages as one Arrow array, built from flat columns."""
    per_page, per_table, per_row = [0], [0], [0]
    row_no, sections, n_data, cells, is_data = [], [], [], [], []
    for tables in pages:
        for table in tables:
            for i, (section, row) in enumerate(table.rows, 1):
                row_no.append(i)
                sections.append(section)
                flags = [data for _, data in row]
                n_data.append(sum(flags))
                is_data += flags
                cells += ["".join([t.strip() for t in c]) if tight else "".join(c).strip() for c, _ in row]
                per_row.append(len(cells))
            per_table.append(len(row_no))
        per_page.append(len(per_table) - 1)
    lists = [pa.ListArray.from_arrays(pa.array(per_row, pa.int32()), v) for v in (pa.array(cells, pa.string()), pa.array(is_data, pa.bool_()))]
    columns = [pa.array(row_no, pa.int32()), pa.array(sections, pa.string()), pa.array(n_data, pa.int32()), *lists]
    rows = pa.StructArray.from_arrays(columns, fields=list(_ARROW_ROW))
    in_tables = pa.ListArray.from_arrays(pa.array(per_table, pa.int32()), rows)
    return pa.ListArray.from_arrays(pa.array(per_page, pa.int32()), in_tables)


def _parser(tight: bool):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_tables(html) if html else [] for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), _rows_array(found, tight)], ["page_id", "tables"])

    return parse


def page_tables(pages: DataFrame, tight: bool = False) -> DataFrame:
    """The tables of each page that has any: (page_id, tables), each table an array of rows.

    Cell texts are stripped as a whole or, if ``tight``, text node by text node.

    A page is one value already, so its tables stay together: everything that needs a whole
    page is an array expression, and no step shuffles.
    """
    # Not a filter: that would be moved before the html is built, which would then be built twice.
    html = F.when(F.col("html").rlike("(?i)<table"), F.col("html"))
    with_table = pages.select("page_id", html.alias("html"))
    return with_table.mapInArrow(_parser(tight), _SCHEMA).where("size(tables) > 0")


def extract_table(pages: DataFrame) -> DataFrame:
    """Rows of the first table of each page: (page_id, row_no, cells), the header being row 1.

    A page without a data row after the header, or whose single data row says that there is
    no data, has no rows.
    """
    first = page_tables(pages).selectExpr(
        "page_id",
        "get(tables, 0) AS rows",
        "filter(get(tables, 0), r -> r.row_no > 1 AND r.n_data > 0) AS data",
    )
    says_none = f"size(data) = 1 AND exists(get(data, 0).cells, c -> lower(c) RLIKE '{_NONE}')"
    kept = first.where(f"size(data) > 0 AND NOT ({says_none})")
    return kept.selectExpr("page_id", "inline(rows)").where("size(cells) > 0").select(
        "page_id", "row_no", "cells"
    )


def extract_tables_union(pages: DataFrame) -> DataFrame:
    """Body rows of all tables of a page that share the page's first header.

    (page_id, table_no, row_no, header, cells): a body row's cells are its td cells. Rows with
    another number of them are left out, and so are tables with another header, without a head or
    without a body.
    """
    # The head cells of a table are the th cells of all its head rows.
    named = "filter(r.cells, (c, i) -> NOT get(r.is_data, i))"
    head = f"flatten(transform(filter(t, r -> r.section = 'thead'), r -> {named}))"
    headed = page_tables(pages, tight=True).selectExpr(
        "page_id",
        f"transform(tables, (t, i) -> struct(i AS table_no, {head} AS head, t AS rows)) AS tables",
    )
    named = headed.selectExpr(
        "page_id", "tables", "get(filter(tables, t -> size(t.head) > 0), 0).head AS header"
    ).where("header IS NOT NULL")
    fitting = (
        "transform(filter(t.rows, r -> r.section = 'tbody' AND r.n_data = size(header)),"
        f" r -> struct(t.table_no, r.row_no, {_DATA} AS cells))"
    )
    body = named.selectExpr(
        "page_id",
        "header",
        f"flatten(transform(filter(tables, t -> t.head = header), t -> {fitting})) AS body",
    )
    says_none = f"size(body) = 1 AND exists(get(body, 0).cells, c -> lower(c) RLIKE '{_NONE}')"
    rows = body.where(f"NOT ({says_none})").selectExpr("page_id", "header", "inline(body)")
    return rows.select("page_id", "table_no", "row_no", "header", "cells")


def extract_records(pages: DataFrame) -> DataFrame:
    """Data rows of the first table as maps from header to td cell: (page_id, row_no, record).

    Rows with fewer cells than the header are left out and extra cells are cut off; of equal
    headers the last one wins.
    """
    first = page_tables(pages).selectExpr(
        "page_id",
        "get(get(tables, 0), 0).cells AS header",
        "transform(slice(get(tables, 0), 2, size(get(tables, 0))),"
        f" r -> struct(r.row_no, {_DATA} AS cells)) AS rows",
    )
    # Per page, so that a row carries the header's columns only, not its page's tables.
    last = F.filter(
        F.transform("header", lambda h, i: F.struct(h.alias("key"), i.alias("at"))),
        lambda e: ~F.array_contains(F.slice("header", e["at"] + 2, F.size("header")), e["key"]),
    )
    headed = first.where("size(header) > 0").withColumn("last", last)
    rows = headed.selectExpr("page_id", "header", "last", "inline(rows)").where("size(cells) > 0")
    data = keep_wellformed_rows(rows, at_least=True)
    record = F.map_from_arrays(
        "last.key", F.transform("last.at", lambda at: F.element_at("cells", at + 1))
    )
    return data.select("page_id", "row_no", record.alias("record"))
