"""Queries of the cleaning, calendar, completeness, dedupe, ingest and report operators."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.catalog.bars import BARS_SQL, bars, table
from barloom.catalog.registry import query, rounded, rounded_sql
from barloom.functions import calendar as C
from barloom.functions import clean as P
from barloom.operators import completeness as G
from barloom.operators import dedupe as D
from barloom.operators.reports import fiscal_year, top_k_report
from barloom.plans.incremental import ingest_history, ingest_today
from barloom.schema import INDEX_BARS, INDEX_HEADERS, STOCK_BARS, STOCK_HEADERS, align_to_schema
from barloom.session import new_folder, written
from barloom.sinks import exports, tables
from barloom.sources.bars import (
    files_for_date,
    read_index_bars,
    read_stock_bars,
    stock_table,
)
from barloom.sources.files import file_hash
from barloom.sources.reports import read_top10_report


def _text(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as text, so that both engines return them alike."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.to_date("o_orderdate").alias("date"), "o_orderpriority", "o_totalprice")


# -- cleaning ---------------------------------------------------------------------------

# Header-like texts made of the tables' own words.
_HEADERS_SQL = """
h as (
  select o_orderkey as id, case o_orderkey % 8
    when 0 then ' ' || o_orderpriority || '. ' when 1 then '52 Weeks High' when 2 then 'Diff  %'
    when 3 then 'Close - LTP %' when 4 then 'Prev. Close' when 5 then '52week low'
    when 6 then ' .' else o_orderstatus || '  x,y ' end as header
  from orders
)"""


@query(
    "normalize_header",
    f"""with {_HEADERS_SQL.strip()},
    b as (select id, lower(trim(header)) as t,
                 regexp_replace(regexp_replace(lower(trim(header)), '[.,]', '', 'g'), '\\s+', '_', 'g') as n
          from h)
    select id, case when t = '52 weeks high' then 'weeks_52_high' when t = '52week low' then 'weeks_52_low'
                    when t = 'close - ltp %' then 'close_minus_ltp_pct' when n = 'diff_%' then 'diff_pct'
                    when n = '' then 'col' when regexp_matches(n, '^[0-9]') then '_' || n else n end as name
    from b""",
)
def normalize_header_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    header = F.expr(
        """CASE o_orderkey % 8
        WHEN 0 THEN ' ' || o_orderpriority || '. ' WHEN 1 THEN '52 Weeks High' WHEN 2 THEN 'Diff  %'
        WHEN 3 THEN 'Close - LTP %' WHEN 4 THEN 'Prev. Close' WHEN 5 THEN '52week low'
        WHEN 6 THEN ' .' ELSE o_orderstatus || '  x,y ' END"""
    )
    return orders.select(F.col("o_orderkey").alias("id"), P.normalize_header(header).alias("name"))


@query(
    "rename_headers",
    "select o_orderkey as id, o_orderpriority as symbol, o_totalprice as close,"
    " o_custkey as trans from orders",
)
def rename_headers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS _id", "o_orderpriority AS ` Symbol `", "o_totalprice AS Close",
        "o_custkey AS `Trans.`", "o_orderstatus AS Other",
    )
    return P.rename_headers(raw, STOCK_HEADERS).withColumnRenamed("_id", "id")


# A number cell in several spellings, some of which are no numbers.
_CELL_SPARK = """CASE o_orderkey % 6
    WHEN 0 THEN format_number(o_totalprice, 2) WHEN 1 THEN ' ' || o_custkey || ' ' WHEN 2 THEN '-'
    WHEN 3 THEN '' WHEN 4 THEN 'nan' ELSE '-' || o_custkey || '.5e2' END"""
_CELL_SQL = """case o_orderkey % 6
    when 0 then format('{:,.2f}', o_totalprice) when 1 then ' ' || o_custkey || ' ' when 2 then '-'
    when 3 then '' when 4 then 'nan' else '-' || o_custkey || '.5e2' end"""
_PARSED_SQL = """case when regexp_matches(replace(cell, ',', ''), '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')
    then cast(trim(replace(cell, ',', '')) as double) end"""


@query(
    "parse_number",
    f"select id, {_PARSED_SQL} as value from (select o_orderkey as id, {_CELL_SQL} as cell from orders)",
)
def parse_number_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.expr(_CELL_SPARK)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), P.parse_number(cell).alias("value")
    )


@query(
    "parse_number_or_text",
    f"""select id, name, {_PARSED_SQL} as value,
               cell <> '' and {_PARSED_SQL} is null as corrupt
        from (select o_orderkey as id, o_orderpriority as name, {_CELL_SQL} as cell from orders)""",
)
def parse_number_or_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name stays text; a measure that is text becomes null and marks its row."""
    cell = F.expr(_CELL_SPARK)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        P.parse_number(cell).alias("value"),
        P.number_is_corrupt(cell).alias("corrupt"),
    )


_FILE_SPARK = """CASE o_orderkey % 4
    WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 1 THEN date_format(o_orderdate, 'yyyyMMdd')
    WHEN 2 THEN date_format(o_orderdate, 'yyyy_MM_dd') ELSE 'notes_' || o_custkey END || '.csv'"""
_FILE_SQL = """case o_orderkey % 4
    when 0 then strftime(o_orderdate, '%Y-%m-%d') when 1 then strftime(o_orderdate, '%Y%m%d')
    when 2 then strftime(o_orderdate, '%Y_%m_%d') else 'notes_' || o_custkey end || '.csv'"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("day"), F.expr(_FILE_SPARK).alias("file")
    )


_FILES_SQL = f"""
f as (select o_orderkey as id, cast(o_orderdate as date) as day, {_FILE_SQL} as file from orders),
d as (select *, case when file not like 'notes%' then day end as date from f)"""


@query("date_from_filename", f"with {_FILES_SQL.strip()} select id, cast(date as varchar) as date from d")
def date_from_filename_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _files(spark, sf_dir)
    return files.select("id", P.date_from_filename(F.col("file")).cast("string").alias("date"))


@query(
    "one_file_per_date",
    f"with {_FILES_SQL.strip()} select cast(date as varchar) as date, max(file) as file from d"
    " where date is not null group by 1",
)
def one_file_per_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _files(spark, sf_dir).withColumn("date", P.date_from_filename(F.col("file")))
    return _text(D.one_file_per_date(files), "date")


_RUN = date(1998, 7, 2)


@query(
    "files_for_date",
    f"with {_FILES_SQL.strip()} select id, file from d where file in ('1998-07-02.csv', '1998_07_02.csv')",
)
def files_for_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files_for_date(_files(spark, sf_dir), _RUN).select("id", "file")


@query(
    "drop_placeholder_rows",
    """select id, symbol from (
         select o_orderkey as id, case o_orderstatus when 'F' then ' No Record Found. ' when 'O' then ''
                else o_orderpriority end as symbol from orders)
       where symbol <> '' and lower(trim(symbol)) <> 'no record found.'""",
)
def drop_placeholder_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbol = "CASE o_orderstatus WHEN 'F' THEN ' No Record Found. ' WHEN 'O' THEN '' ELSE o_orderpriority END"
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", f"{symbol} AS symbol")
    return P.drop_placeholder_rows(rows)


@query(
    "pad_ragged",
    """select o_orderkey as id, cast(o_custkey as varchar) as a,
              case when o_orderstatus in ('F', 'O') then o_orderpriority end as b,
              case when o_orderstatus = 'F' then o_orderstatus end as c
       from orders""",
)
def pad_ragged_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = """CASE o_orderstatus
        WHEN 'F' THEN array(string(o_custkey), o_orderpriority, o_orderstatus)
        WHEN 'O' THEN array(string(o_custkey), o_orderpriority)
        ELSE array(string(o_custkey), '') END"""
    padded = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), P.pad_ragged(F.expr(cells), 3).alias("x")
    )
    return padded.selectExpr("id", "x[0] AS a", "x[1] AS b", "x[2] AS c")


@query(
    "keep_wellformed_rows",
    "select conv_id, turn from conversations where len(string_split(text, ',')) = 2",
)
def keep_wellformed_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.split("text", ",").alias("cells"), F.array(F.lit("a"), F.lit("b")).alias("header")
    )
    return P.keep_wellformed_rows(rows).select("conv_id", "turn")


@query(
    "coerce_numeric",
    """select o_orderkey as id, try_cast(case when o_orderstatus = 'P' then o_orderpriority
              else cast(o_custkey as varchar) end as double) as value,
              case when o_orderstatus = 'P' then null else strftime(o_orderdate, '%Y-%m-%d') end as day
       from orders""",
)
def coerce_numeric_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    partial = F.col("o_orderstatus") == "P"
    number = F.when(partial, F.col("o_orderpriority")).otherwise(F.col("o_custkey").cast("string"))
    day = F.when(partial, F.lit("some day")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        P.coerce_numeric(number).alias("value"),
        P.normalize_date(day).cast("string").alias("day"),
    )


@query(
    "nan_to_null",
    "select event_id as id, case when event_type <> 'error' then value end as value from events",
)
def nan_to_null_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.expr("CASE WHEN event_type = 'error' THEN double('nan') ELSE value END")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), P.nan_to_null(value).alias("value")
    )


# -- calendar ---------------------------------------------------------------------------


@query(
    "is_weekend",
    "select o_orderkey as id, dayofweek(o_orderdate) in (5, 6) as closed from orders",
)
def is_weekend_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _order_days(spark, sf_dir)
    return days.select(F.col("o_orderkey").alias("id"), C.is_weekend(F.col("date")).alias("closed"))


@query(
    "latest_trading_day",
    """select o_orderkey as id, cast(cast(o_orderdate as date)
         - case dayofweek(o_orderdate) when 5 then 1 when 6 then 2 else 0 end as varchar) as day
       from orders""",
)
def latest_trading_day_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _order_days(spark, sf_dir)
    open_day = C.latest_trading_day(F.col("date")).cast("string")
    return days.select(F.col("o_orderkey").alias("id"), open_day.alias("day"))


_CALENDAR_SQL = """
cal as (select cast(unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)),
        interval 1 day)) as date) as date from orders),
opened as (select date from cal where dayofweek(date) not in (5, 6))"""


@query(
    "trading_days",
    f"with {_CALENDAR_SQL.strip()} select cast(date as varchar) as date from opened order by date desc",
)
def trading_days_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo, hi = _order_days(spark, sf_dir).agg(F.min("date"), F.max("date")).first()
    return _text(C.trading_days(spark, lo, hi, desc=True), "date")


_EVEN_SQL = "cast(o_orderdate as date) - cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) % 2 as int)"
_EVEN = "date_sub(to_date(o_orderdate), unix_date(to_date(o_orderdate)) % 2)"


@query(
    "missing_trading_days",
    f"""with {_CALENDAR_SQL.strip()},
    days as (select distinct {_EVEN_SQL} as date from orders)
    select cast(date as varchar) as date from opened
    where date between (select min(date) from days) and (select max(date) from days)
      and date not in (select date from days)""",
)
def missing_trading_days_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders are put on even days, so the odd open days have none."""
    return _text(C.missing_trading_days(table(spark, sf_dir, "orders").selectExpr(f"{_EVEN} AS date")), "date")


# -- completeness -----------------------------------------------------------------------


@query("existing_dates", "select distinct cast(cast(o_orderdate as date) as varchar) as date from orders")
def existing_dates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(G.existing_dates(_order_days(spark, sf_dir)), "date")


@query(
    "rows_per_date",
    "select cast(cast(o_orderdate as date) as varchar) as date, count(*) as n_rows from orders group by 1",
)
def rows_per_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(G.rows_per_date(_order_days(spark, sf_dir)), "date")


@query(
    "series_profile",
    "select count(distinct o_custkey) as symbols, count(distinct cast(o_orderdate as date)) as dates from orders",
)
def series_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return G.series_profile(orders.withColumn("date", F.to_date("o_orderdate")), "o_custkey")


# All orders stand for bars; all of them, put on even days, for rows that are computed (some incompletely).
_DATES_SQL = f"""
b as (select distinct cast(o_orderdate as date) as date from orders),
i as (select {_EVEN_SQL} as date, case when o_orderkey % 50 <> 7 then 1.0 end as rsi_14 from orders)"""


def _done_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders")
    return done.selectExpr(f"{_EVEN} AS date", "CASE WHEN o_orderkey % 50 <> 7 THEN 1D END AS rsi_14")


def _bar_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("to_date(o_orderdate) AS date", "o_orderkey")


@query(
    "dates_to_compute",
    f"""with {_DATES_SQL.strip()}
    select cast(date as varchar) as date from
      (select date from b where date not in (select date from i) union select date from i where rsi_14 is null)""",
)
def dates_to_compute_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = G.dates_to_compute(_bar_orders(spark, sf_dir), _done_orders(spark, sf_dir))
    return _text(dates, "date")


@query(
    "restrict_to_dates",
    f"""with {_DATES_SQL.strip()}
    select o_orderkey, cast(cast(o_orderdate as date) as varchar) as date from orders
    where cast(o_orderdate as date) in (select date from i where rsi_14 is null)""",
)
def restrict_to_dates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = G.incomplete_dates(_done_orders(spark, sf_dir))
    return _text(G.restrict_to_dates(_bar_orders(spark, sf_dir), dates), "date")


@query(
    "not_yet_loaded",
    f"""with {_DATES_SQL.strip()}
    select o_orderkey, cast(cast(o_orderdate as date) as varchar) as date from orders
    where cast(o_orderdate as date) not in (select date from i)""",
)
def not_yet_loaded_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(G.not_yet_loaded(_bar_orders(spark, sf_dir), _done_orders(spark, sf_dir)), "date")


@query(
    "newest_first_until",
    f"with {_FILES_SQL.strip()} select id, cast(date as varchar) as date from d where date > date '2000-01-01'"
    " order by date desc, id",
)
def newest_first_until_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _files(spark, sf_dir).select("id", P.date_from_filename(F.col("file")).alias("date"))
    return _text(G.newest_first_until(files, date(2000, 1, 1)), "date")


# -- duplicates -------------------------------------------------------------------------

# A document is a file, its lines are rows of one cell.
_PRINTS_SQL = """
lines as (select doc_id, unnest(string_split(text, chr(10))) as line from documents),
trimmed as (select doc_id, regexp_replace(line, '^[ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]+$', '', 'g') as c from lines),
hashed as (select doc_id, md5(length(c) || ':' || c) as h from trimmed),
sums as (select doc_id, count(*) as n_rows,
           sum(cast('0x' || substr(h, 1, 8) as bigint)) as a, sum(cast('0x' || substr(h, 9, 8) as bigint)) as b,
           sum(cast('0x' || substr(h, 17, 8) as bigint)) as c, sum(cast('0x' || substr(h, 25, 8) as bigint)) as d
         from hashed group by doc_id),
prints as (select doc_id, n_rows, md5(concat_ws(',', n_rows, a, b, c, d)) as fingerprint from sums),
firsts as (select fingerprint, min(doc_id) as kept, count(*) as copies from prints group by fingerprint)"""


def _prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return D.content_fingerprint(lines.select("doc_id", F.array("line").alias("cells")), "doc_id")


@query("content_fingerprint", f"with {_PRINTS_SQL.strip()} select * from prints")
def content_fingerprint_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prints(spark, sf_dir)


@query(
    "find_duplicates",
    f"with {_PRINTS_SQL.strip()} select doc_id, kept, fingerprint from prints join firsts using (fingerprint)"
    " where doc_id <> kept",
)
def find_duplicates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.find_duplicates(_prints(spark, sf_dir), "doc_id")


@query("drop_duplicates_keep_first", f"with {_PRINTS_SQL.strip()} select * from firsts")
def drop_duplicates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.drop_duplicates_keep_first(_prints(spark, sf_dir), "doc_id")


@query(
    "duplicate_summary",
    f"""with {_PRINTS_SQL.strip()} select cast(sum(copies) as bigint) as files,
        cast(sum(copies - 1) as bigint) as duplicates, count(*) as remaining from firsts""",
)
def duplicate_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.duplicate_summary(_prints(spark, sf_dir), "doc_id")


@query(
    "dedupe_bars",
    """select cast(date as varchar) as date, symbol, max(close) as close, max(file) as file from (
         select cast(o_orderdate as date) as date, o_orderpriority as symbol, o_orderkey as file,
                o_totalprice as close, max(o_orderkey) over (partition by cast(o_orderdate as date), o_orderpriority) as last
         from orders) where file = last group by 1, 2""",
)
def dedupe_bars_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "orders").selectExpr(
        "to_date(o_orderdate) AS date", "o_orderpriority AS symbol", "o_totalprice AS close", "o_orderkey AS file"
    )
    return _text(D.dedupe_bars(raw, "file"), "date")


@query(
    "file_hash",
    """select c_nationkey as nation, sum(length(l) + 1) as bytes, md5(string_agg(l || chr(10), '' order by c_custkey)) as md5
    from (select *, c_custkey || '|' || c_name as l from customer) group by 1""",
)
def file_hash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The MD5 of text files that list the customers of a nation by key, one file per nation."""
    path = new_folder(spark, "lists")
    lines = table(spark, sf_dir, "customer").select(
        "c_nationkey", "c_custkey", F.concat_ws("|", "c_custkey", "c_name").alias("line")
    )
    ordered = lines.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    ordered.drop("c_custkey").write.partitionBy("c_nationkey").text(path)
    nation = F.regexp_extract("file", "c_nationkey=([0-9]+)/", 1).cast("bigint").alias("nation")
    return file_hash(spark, path, "*.txt").select(nation, "bytes", "md5")


# -- sinks ------------------------------------------------------------------------------

_KEPT = ["close", "vol"]
_BEFORE, _FROM = "date < date '1999-01-01'", "date >= date '1998-07-01'"


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A loaded table and a later delivery that overlaps it, with corrected closes."""
    all_bars = bars(spark, sf_dir).select("date", "symbol", *_KEPT)
    loaded = all_bars.where(_BEFORE.replace("date '", "DATE '"))
    new = all_bars.where(_FROM.replace("date '", "DATE '")).withColumn("close", F.col("close") + 1)
    return loaded, new


_SPLIT_SQL = f"""{BARS_SQL.strip()},
loaded as (select date, symbol, close, vol from bars where {_BEFORE}),
new as (select date, symbol, close + 1 as close, vol from bars where {_FROM})"""


@query(
    "append_new_dates",
    f"with {_SPLIT_SQL} select {rounded_sql(_KEPT, 4)} from new where date not in (select date from loaded)",
)
def append_new_dates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded, new = _split(spark, sf_dir)
    return rounded(tables.append_new_dates(new, loaded), _KEPT, 4)


_SAME_SQL = """
n as (select date, count(*) as k from new group by date),
l as (select date, count(*) as k from loaded group by date),
chosen as (select * from new where date in (select n.date from n left join l using (date)
           where l.k is null or l.k <> n.k))"""


@query(
    "skip_if_same_count",
    f"""with {_SPLIT_SQL.replace("from bars where " + _FROM, "from bars where " + _FROM + " and (symbol <> 'Brand#1' or date > date '1998-10-01')")},
    {_SAME_SQL.strip()}
    select {rounded_sql(_KEPT, 4)} from loaded where (date, symbol) not in (select (date, symbol) from chosen)
    union all select {rounded_sql(_KEPT, 4)} from chosen""",
)
def skip_if_same_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded, new = _split(spark, sf_dir)
    partial = new.where("symbol <> 'Brand#1' OR date > DATE '1998-10-01'")
    return rounded(tables.skip_if_same_count(partial, loaded), _KEPT, 4)


_UPSERT_SQL = f"""with {_SPLIT_SQL}
    select {rounded_sql(_KEPT, 4)} from loaded where (date, symbol) not in (select (date, symbol) from new)
    union all select {rounded_sql(_KEPT, 4)} from new"""


@query("upsert", _UPSERT_SQL)
def upsert_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded, new = _split(spark, sf_dir)
    return rounded(tables.upsert(new, loaded), _KEPT, 4)


@query(
    "align_to_schema",
    f"""with {BARS_SQL.strip()} select cast(date as varchar) as date, symbol, cast(null as double) as conf,
        open, close, cast(null as double) as weeks_52_low from bars""",
)
def align_to_schema_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_to_schema(bars(spark, sf_dir), STOCK_BARS)
    return _text(aligned.select("date", "symbol", "conf", "open", "close", "weeks_52_low"), "date")


# -- files ------------------------------------------------------------------------------

# One stock file per day of the events: users are symbols, their events are trades.
_STOCK_SQL = """
stock as (
  select cast(ts as date) as date, 'U' || user_id as symbol, first(value order by event_id) as open,
         max(value) as high, min(value) as low, last(value order by event_id) as close,
         cast(count(*) as double) as vol, cast(sum(cast(round(value * 100) as bigint)) as double) as turnover
  from events group by 1, 2
)"""


def _daily_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("date"), F.concat(F.lit("U"), "user_id").alias("symbol"))
        .agg(
            F.min_by("value", "event_id").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "event_id").alias("close"),
            F.format_number(F.count(F.lit(1)), 0).alias("vol"),
            F.format_number(F.sum(F.round(F.col("value") * 100).cast("bigint")), 0).alias("turnover"),
        )
    )


def stock_cells() -> dict[str, str]:
    return {column: header for header, column in STOCK_HEADERS.items()}


def _stock_files(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark, "stock-files")
    exports.write_table_csv(_daily_stock(spark, sf_dir), path, stock_cells())
    return path


_STOCK_OUT = ["open", "high", "low", "close", "vol", "turnover"]


def _deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """A first delivery of the daily stock bars and a second one, corrected, that overlaps it."""
    daily = written(_daily_stock(spark, sf_dir).drop("vol", "turnover"), "stock")
    second = daily.where("date >= DATE '2024-01-10'").withColumn("close", F.col("close") + 1)
    return [daily.where("date < DATE '2024-01-20'"), second]


_DELIVERY_SQL = f"""{_STOCK_SQL.strip()},
loaded as (select * from stock where date < date '2024-01-20'),
new as (select * replace (close + 1 as close) from stock where date >= date '2024-01-10')"""
_PRICES = ["open", "high", "low", "close"]


@query(
    "append_table",
    f"""with {_DELIVERY_SQL} select {rounded_sql(_PRICES, 4)} from loaded union all
        select {rounded_sql(_PRICES, 4)} from new where date not in (select date from loaded)""",
)
def append_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries written to a table, the second one skipping the dates it holds."""
    path = new_folder(spark, "appended")
    for part in _deliveries(spark, sf_dir):
        tables.write_new_dates(part, path, STOCK_BARS)
    return rounded(tables.read_table(spark, path, STOCK_BARS), _PRICES, 4)


@query(
    "upsert_table",
    f"""with {_DELIVERY_SQL}
    select {rounded_sql(_PRICES, 4)} from loaded where (date, symbol) not in (select (date, symbol) from new)
    union all select {rounded_sql(_PRICES, 4)} from new""",
)
def upsert_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same deliveries upserted; only the touched dates are read and replaced."""
    path = new_folder(spark, "upserted")
    for part in _deliveries(spark, sf_dir):
        tables.write_upsert(part, path, STOCK_BARS)
    return rounded(tables.read_table(spark, path, STOCK_BARS), _PRICES, 4)


_COUNTED = "symbol <> 'U7'"


@query(
    "stored_counts",
    f"""with {_STOCK_SQL.strip()} select cast(date as varchar) as date, count(*) as n_rows, count(*) as n_close,
    count(case when {_COUNTED} then vol end) as n_vol, 0 as n_trans from stock group by date""",
)
def stored_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and values per date of a stored table, from its footers; the table lacks some volumes."""
    path = new_folder(spark, "counted")
    stock = stock_table(_daily_stock(spark, sf_dir).drop("vol", "turnover")).withColumn("vol", F.expr(f"CASE WHEN {_COUNTED} THEN 1D END"))
    tables.write_new_dates(stock, path, STOCK_BARS)
    return _text(tables.stored_counts(spark, path, STOCK_BARS, ("close", "vol", "trans")), "date")


@query(
    "stored_incomplete_dates",
    f"with {_STOCK_SQL.strip()} select distinct cast(date as varchar) as date from stock where not ({_COUNTED})",
)
def stored_incomplete_dates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "probed")
    stock = stock_table(_daily_stock(spark, sf_dir).drop("vol", "turnover")).withColumn("vol", F.expr(f"CASE WHEN {_COUNTED} THEN 1D END"))
    tables.write_new_dates(stock, path, STOCK_BARS)
    return _text(tables.stored_incomplete_dates(spark, path, STOCK_BARS, ("close", "vol", "rsi_14")), "date")


@query("read_stock_bars", f"with {_STOCK_SQL.strip()} select {rounded_sql(_STOCK_OUT, 4)} from stock")
def read_stock_bars_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_stock_bars(spark, _stock_files(spark, sf_dir))
    return rounded(stock_table(rows), _STOCK_OUT, 4)


@query(
    "bars_for_date",
    f"with {_STOCK_SQL.strip()} select {rounded_sql(_STOCK_OUT, 4)} from stock where date = date '2024-01-15'",
)
def bars_for_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_stock_bars(spark, _stock_files(spark, sf_dir), date(2024, 1, 15))
    return rounded(stock_table(rows), _STOCK_OUT, 4)


@query(
    "write_table_csv",
    f"with {_STOCK_SQL.strip()} select cast(date as varchar) as date, symbol, close from stock",
)
def write_table_csv_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.read.option("header", True).csv(_stock_files(spark, sf_dir))
    return raw.selectExpr("string(date) AS date", "Symbol AS symbol", "double(Close) AS close")


_INDEX_SQL = """
idx as (
  select cast(ts as date) as date, event_type as index,
         cast(count(*) * 1000 as double) as current,
         cast(null as double) as point_change, cast(count(distinct user_id) as double) as pct_change,
         cast(sum(cast(round(value * 100) as bigint)) as double) as turnover
  from events group by 1, 2
)"""


def _daily_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = F.count_distinct("user_id")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("date"), F.col("event_type").alias("index"))
        .agg(
            F.format_number(F.count(F.lit(1)) * 1000, 2).alias("current"),
            F.lit("n/a").alias("point_change"),
            users.cast("string").alias("pct_change"),
            F.format_number(F.sum(F.round(F.col("value") * 100).cast("bigint")), 2).alias("turnover"),
        )
    )


_INDEX_OUT = ["current", "point_change", "pct_change", "turnover"]


@query(
    "read_index_bars",
    f"""with {_INDEX_SQL.strip()} select {rounded_sql(_INDEX_OUT, 4, ['"index"'])}, true as corrupt from idx""",
)
def read_index_bars_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "index-files")
    titles = {column: header for header, column in INDEX_HEADERS.items()}
    daily = written(_daily_index(spark, sf_dir), "index")
    exports.write_table_csv(daily.where("date < DATE '2024-01-15'"), f"{path}/a", titles)
    exports.write_table_csv(daily.where("date >= DATE '2024-01-15'"), f"{path}/b")
    rows = read_index_bars(spark, path)
    return rounded(rows, _INDEX_OUT, 4, ["index", F.col("_corrupt").alias("corrupt")])


@query(
    "ingest_today",
    f"""with {_STOCK_SQL.strip()}, {_INDEX_SQL.strip()}
    select cast(date as varchar) as date, symbol as name, turnover from stock where date = date '2024-01-15'
    union all
    select cast(date as varchar) as date, "index" as name, turnover from idx where date = date '2024-01-15'""",
)
def ingest_today_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both loads run twice; the second time they skip the date."""
    path = new_folder(spark, "ingest")
    stock = _stock_files(spark, sf_dir)
    exports.write_table_csv(_daily_index(spark, sf_dir), f"{path}/files")
    for _ in range(2):
        ingest_today(
            spark, date(2024, 1, 15), stock, f"{path}/stock", f"{path}/files", f"{path}/index"
        )
    loaded = tables.read_table(spark, f"{path}/stock", STOCK_BARS).select(
        "date", F.col("symbol").alias("name"), "turnover"
    )
    indexes = tables.read_table(spark, f"{path}/index", INDEX_BARS).select(
        "date", F.col("index").alias("name"), "turnover"
    )
    return _text(loaded.unionAll(indexes), "date")


_FIRST, _LAST, _FIXED = "DATE '2024-01-05'", "DATE '2024-01-20'", "DATE '2024-01-12'"


@query(
    "ingest_history",
    f"""with {_STOCK_SQL.strip()}
    select {rounded_sql(_PRICES, 4)} from (select * replace (case when date = {_FIXED} then close + 1 else close end as close) from stock)
    where date > {_FIRST} and (date <> {_LAST} or symbol >= 'U5') and date <> date '2024-01-15'
    union all
    select cast(date as varchar) as date, symbol, round(open, 4) + 0.0 as open, round(high, 4) + 0.0 as high,
           round(low, 4) + 0.0 as low, 1.0 as close from stock where date = date '2024-01-15'""",
)
def ingest_history_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with dates up to the cutoff, a date that is loaded already, a second file of one
    date, which counts instead of the first, a copy of a file under a later date, and a date delivered
    into the same folder once more, corrected."""
    root = new_folder(spark, "history")
    daily = written(_daily_stock(spark, sf_dir), "stock")
    copied = daily.where(f"date = {_LAST} - 4").withColumn("date", F.expr("DATE '2024-03-01'"))
    again = daily.where(f"date = {_LAST} AND symbol >= 'U5'")
    exports.write_table_csv(daily, f"{root}/files/a", stock_cells())
    exports.write_table_csv(again.unionByName(copied), f"{root}/files/b", stock_cells())
    corrected = daily.where(f"date = {_FIXED}").withColumn("close", F.col("close") + 1)
    exports.write_table_csv(corrected, f"{root}/files/a", stock_cells())
    held = daily.where("date = DATE '2024-01-15'").withColumn("close", F.lit(1.0)).drop("vol", "turnover")
    tables.write_new_dates(held, f"{root}/table", STOCK_BARS)
    ingest_history(spark, f"{root}/files", f"{root}/table", cutoff=date(2024, 1, 5))
    return rounded(tables.read_table(spark, f"{root}/table", STOCK_BARS), _PRICES, 4)


# -- reports ----------------------------------------------------------------------------


def _top_sql(value: str, period: str | None = None) -> str:
    p = f"{period} as period, " if period else ""
    part = "partition by period " if period else ""
    keep = "period, " if period else ""
    return f"""with {BARS_SQL.strip()},
    sums as (select {p}symbol, {value} as value from bars group by all),
    ranked as (select *, cast(row_number() over ({part}order by value desc, symbol) as int) as rank from sums)
    select {keep}symbol, rank, round(value, 2) as value from ranked where rank <= 10"""


@query("top_k_report", _top_sql("sum(turnover)"))
def top_k_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = top_k_report(bars(spark, sf_dir), "turnover")
    return top.select("symbol", "rank", F.round("value", 2).alias("value"))


_FISCAL_SQL = "cast(year(date) - case when (month(date), day(date)) >= (7, 16) then 0 else 1 end as int)"


@query("top_k_per_fiscal_year", _top_sql("sum(vol)", _FISCAL_SQL))
def top_k_per_fiscal_year_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = top_k_report(bars(spark, sf_dir), "shares_traded", period=fiscal_year(F.col("date")))
    return top.select("period", "symbol", "rank", F.round("value", 2).alias("value"))


@query("top_k_transactions", _top_sql("sum(trans)", "year(date)").replace("year(date) as period", "cast(year(date) as int) as period"))
def top_k_transactions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = top_k_report(bars(spark, sf_dir), "transactions", period=F.year("date"))
    return top.select("period", "symbol", "rank", F.round("value", 2).alias("value"))


@query(
    "top_k_market_cap",
    f"""with {BARS_SQL.strip()},
    shares as (select p_brand as symbol, sum(p_size) as shares from part group by 1),
    ends as (select symbol, arg_max(close, date) as close from bars group by 1),
    caps as (select symbol, close * shares as value from ends join shares using (symbol))
    select symbol, cast(row_number() over (order by value desc, symbol) as int) as rank, round(value, 2) as value
    from caps qualify rank <= 10""",
)
def top_k_market_cap_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("symbol")).agg(
        F.sum("p_size").alias("shares_outstanding")
    )
    top = top_k_report(bars(spark, sf_dir), "market_cap", shares=shares)
    return top.select("symbol", "rank", F.round("value", 2).alias("value"))


@query(
    "read_top10_report",
    _top_sql("sum(turnover)", _FISCAL_SQL).replace("round(value, 2)", "round(value / 1000000, 4)").replace(
        "select period, symbol, rank", "select symbol || ' Limited' as security_name, symbol, rank"
    ),
)
def read_top10_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of every fiscal year, written with a letterhead and blank columns, read again."""
    top = top_k_report(bars(spark, sf_dir), "turnover", period=fiscal_year(F.col("date")))
    value = F.round(F.col("value") / 1000000, 4).cast("decimal(20,4)")
    # Row number in the file, then the seven cells; at most ten ranked rows per year.
    ranked = top.select(
        "period", (F.col("rank") + 10).alias("line"),
        F.array(
            F.col("rank").cast("string"), F.concat("symbol", F.lit(" Limited")), F.lit(None), F.lit(None),
            F.col("symbol"), F.lit(None), value.cast("string"),
        ).alias("c"),
    )
    letterhead = """array(
        struct(1 AS line, array('.', 'Exchange\\nCity, Country\\nPhone: 1', null, null, null, null, null) AS c),
        struct(2 AS line, array(null, 'Top 10 by Amount Traded', null, null, null, null, null) AS c),
        struct(3 AS line, array('S.N.', 'SECURITY_NAME', null, null, 'SYMBOL', null, 'AMOUNT') AS c))"""
    heads = top.select("period").distinct().selectExpr("period", f"inline({letterhead})")
    lines = heads.unionAll(ranked).select("period", "line", *[F.col("c")[i].alias(f"c{i}") for i in range(7)])
    path = new_folder(spark, "reports")
    (
        lines.repartition("period")
        .sortWithinPartitions("period", "line")
        .drop("line")
        .write.partitionBy("period")
        .csv(path)
    )
    return read_top10_report(spark, path).select("security_name", "symbol", "rank", "value")


_LISTING_SQL = """
r as (select '{"Name":"' || c_name || '","Nation":"' || n_name || '"}' as json
      from customer join nation on c_nationkey = n_nationkey),
lines as (
  select 0 as part, '{"scraping_info":{"source_url":"https://example.org/listing","scraped_at":"2024-01-01T00:00:00",'
         || '"total_companies":' || count(*) || '}},"companies":[' as line from r
  union all select 1, case when row_number() over (order by json) = 1 then '' else ',' end || json from r
  union all select 2, ']}'
)""".replace("}},", "},")


@query("to_json_document", f"with {_LISTING_SQL.strip()} select part, line from lines")
def to_json_document_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of all customers as the lines of one document."""
    lines = exports.to_json_document(_listing(spark, sf_dir), "https://example.org/listing", datetime(2024, 1, 1))
    return lines.select("part", "line")


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return named.select(F.create_map(F.lit("Name"), "c_name", F.lit("Nation"), "n_name").alias("record"))


@query("write_json_document", f"with {_LISTING_SQL.strip()} select line from lines")
def write_json_document_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same document written to files and read again."""
    path = new_folder(spark, "listing")
    exports.write_json_document(_listing(spark, sf_dir), path, "https://example.org/listing", datetime(2024, 1, 1))
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("write_json_lines", "select c_name as name, n_name as nation from customer join nation on c_nationkey = n_nationkey")
def write_json_lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "json-lines")
    exports.write_json_lines(_listing(spark, sf_dir), path)
    back = spark.read.schema("record map<string,string>").json(path)
    return back.select(F.col("record")["Name"].alias("name"), F.col("record")["Nation"].alias("nation"))
