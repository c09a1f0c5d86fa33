"""Queries of the HTML table operators, over pages that Spark derives from the orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.catalog.bars import table
from barloom.catalog.registry import query
from barloom.functions.clean import drop_no_data
from barloom.sources.pages import extract_records, extract_table, extract_tables_union

# Orders of status F have a page that says so instead of listing lines.
_LINES_SQL = """
lines as (
  select l_orderkey as page_id, o_orderstatus as status, cast(l_linenumber as varchar) as c1,
         cast(l_partkey as varchar) as c2, cast(cast(l_quantity as int) as varchar) as c3, l_linenumber,
         row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, cast(l_quantity as int)) as n
  from lineitem join orders on l_orderkey = o_orderkey
)"""

_NONE = "<tr><td colspan=3> No Record Found. </td></tr>"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: its lines in order. An order has a handful of lines."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "struct(l_linenumber, l_partkey, int(l_quantity) AS qty) AS line"
    )
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderstatus AS status")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("l_orderkey").alias("page_id"), "status")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )


def _rows(lines: str) -> str:
    row = "'<tr><td>\\n ' || l.l_linenumber || '</td><td>' || l.l_partkey || ' </td><td><b>' || l.qty || '</b></td></tr>'"
    return f"array_join(transform({lines}, l -> {row}), '')"


def _page(body: str) -> str:
    return f"'<html><body><p>Lines &amp; parts</p>' || {body} || '</body></html>'"


@query(
    "extract_table",
    f"""with {_LINES_SQL.strip()}
    select page_id, 1 as row_no, 'Line' as c1, 'Part' as c2, 'Qty' as c3 from lines where status <> 'F' group by 1
    union all select page_id, cast(n + 1 as int), c1, c2, c3 from lines where status <> 'F'""",
)
def extract_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = "'<table><tr><th>Line</th><th>Part</th><th> Qty </th></tr>'"
    rows = f"CASE WHEN status = 'F' THEN '{_NONE}' ELSE {_rows('lines')} END"
    html = _page(f"{head} || {rows} || '</table><table><tr><td>x</td></tr></table>'")
    pages = _orders(spark, sf_dir).selectExpr("page_id", f"{html} AS html")
    return extract_table(pages).selectExpr(
        "page_id", "row_no", "cells[0] AS c1", "cells[1] AS c2", "cells[2] AS c3"
    )


@query(
    "extract_tables_union",
    f"""with {_LINES_SQL.strip()}
    select page_id, case when l_linenumber <= 2 then 0 else 2 end as table_no, c1, c2, c3
    from lines where status <> 'F'""",
)
def extract_tables_union_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in two tables of one header, between them a table of another header."""

    def part(head: str, rows: str) -> str:
        return f"'<table><thead><tr>{head}</tr></thead><tbody>' || {rows} || '</tbody></table>'"

    head = "<th>Line</th><th>Part</th><th>Qty</th>"
    body = " || ".join(
        [
            part(head, _rows("filter(lines, l -> l.l_linenumber <= 2)") + " || '<tr><td>short</td></tr>'"),
            part("<th>Other</th>", "'<tr><td>1</td></tr>'"),
            part(head, _rows("filter(lines, l -> l.l_linenumber > 2)")),
            "'<table><tr><td>1</td><td>2</td><td>3</td></tr></table>'",
        ]
    )
    empty = part("<th>Line</th>", "'<tr><td>No data found</td></tr>'")
    html = f"CASE WHEN status = 'F' THEN {_page(empty)} ELSE {_page(body)} END"
    pages = _orders(spark, sf_dir).selectExpr("page_id", f"{html} AS html")
    return extract_tables_union(pages).selectExpr(
        "page_id", "table_no", "cells[0] AS c1", "cells[1] AS c2", "cells[2] AS c3"
    )


@query(
    "extract_records",
    f"with {_LINES_SQL.strip()} select page_id, cast(n + 1 as int) as row_no, c1 as line, c3 as part, 2 as fields from lines",
)
def extract_records_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header names two columns alike, of which the later one counts."""
    head = "'<table><tr><th>Line</th><th>Part</th><th>Part</th></tr>'"
    html = _page(f"{head} || '<tr><td>short</td></tr>' || '</table>'")
    html = html.replace("'<tr><td>short</td></tr>'", _rows("lines") + " || '<tr><td>short</td></tr>'")
    pages = _orders(spark, sf_dir).selectExpr("page_id", f"{html} AS html")
    return extract_records(pages).selectExpr(
        "page_id", "row_no", "record['Line'] AS line", "record['Part'] AS part", "size(record) AS fields"
    )


@query(
    "drop_no_data",
    """with r as (select l_orderkey as page_id, l_partkey as part, l_returnflag as flag,
                       count(*) over (partition by l_orderkey) as n from lineitem)
    select page_id, part, flag from r where not (n = 1 and flag = 'R')""",
)
def drop_no_data_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS page_id", "2 AS row_no", "l_partkey AS part", "l_returnflag AS flag",
        "array(CASE WHEN l_returnflag = 'R' THEN 'Sorry, No Data Found!' ELSE l_returnflag END) AS cells",
    )
    return drop_no_data(rows).select("page_id", "part", "flag")
