"""Daily bar files and the series read from bar tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.clean import (
    coerce_numeric,
    date_from_filename,
    delivery_place,
    drop_placeholder_rows,
    normalize_date,
    number_is_corrupt,
    parse_number,
    strip,
)
from barloom.operators.dedupe import dedupe_bars
from barloom.schema import INDEX_BARS, INDEX_HEADERS, STOCK_BARS, STOCK_HEADERS, align_to_schema
from barloom.sources.csv_files import columns_of, read_files

# Cells that only a header row has.
STOCK_MARKER, INDEX_MARKER = ("Symbol",), ("Index", "index")
SERIES_MEASURES = ("open", "high", "low", "close", "ltp", "vol")


def is_header(cells: DataFrame, marker: tuple[str, ...]) -> Column:
    """True for the rows with a ``marker`` cell."""
    trimmed = F.transform(cells["cells"], lambda c: strip(F.coalesce(c, F.lit(""))))
    return F.arrays_overlap(trimmed, F.array(*[F.lit(m) for m in marker]))


def _by_header(cells: DataFrame, marker: tuple[str, ...], names: Mapping[str, str]) -> DataFrame:
    """Columns found by header name, file by file, so files may order their columns freely.

    A file's header is its row with a ``marker`` cell. It is reduced to the positions of the
    known columns, one small row per file. For cells that are stored; ``columns_of`` finds the columns
    of files that are still to be parsed.
    """
    trimmed = F.transform("cells", lambda c: strip(F.coalesce(c, F.lit(""))))
    rows = cells.withColumn("_trimmed", trimmed)
    is_header = F.arrays_overlap("_trimmed", F.array(*[F.lit(m) for m in marker]))

    def position(column: str):
        found = [F.array_position("_trimmed", F.lit(h)) for h, n in names.items() if n == column]
        return F.coalesce(*[F.nullif(p, F.lit(0).cast("bigint")) for p in found])

    columns = list(dict.fromkeys(names.values()))
    headers = (
        rows.where(is_header)
        .groupBy("file")
        .agg(*[F.max(position(c)).cast("int").alias(f"_p_{c}") for c in columns])
    )
    data = rows.where(~is_header).join(headers, "file")
    cell = {c: F.expr(f"CASE WHEN _p_{c} IS NOT NULL THEN get(cells, _p_{c} - 1) END") for c in columns}
    return data.select("file", "modified", *[v.alias(c) for c, v in cell.items()])


def read_stock_bars(spark: SparkSession, path: str | list[str], run_date: date | None = None) -> DataFrame:
    """Typed stock bars of a folder of daily files, with the file each row came from.

    Each file is parsed once. With ``run_date`` only the files of that date are opened.
    """
    return _for(run_date, stock_rows_of(read_files(spark, path, run_date)))


def _for(run_date: date | None, rows: DataFrame) -> DataFrame:
    return rows if run_date is None else bars_for_date(rows, run_date)


def stock_rows(cells: DataFrame) -> DataFrame:
    """Typed stock bars from stored (file, modified, cells) rows; see ``stock_rows_of``."""
    return _typed_stock(_by_header(cells, STOCK_MARKER, STOCK_HEADERS))


def stock_rows_of(files: DataFrame) -> DataFrame:
    """Typed stock bars from whole files (file, modified, value).

    Files without a date in their name are skipped, as are rows without a symbol and the
    row that says that a day has no record.
    """
    return _typed_stock(columns_of(files, STOCK_MARKER, STOCK_HEADERS))


def _typed_stock(named: DataFrame) -> DataFrame:
    rows = drop_placeholder_rows(named)
    measures = [c for c in STOCK_HEADERS.values() if c != "symbol"]
    typed = rows.select(
        date_from_filename(F.col("file")).alias("date"),
        "symbol",
        *[parse_number(F.col(c)).alias(c) for c in measures],
        "file",
        "modified",
    )
    return typed.where("date IS NOT NULL")


_INDEX_NAMES = INDEX_HEADERS | {n: n for n in INDEX_HEADERS.values()}


def read_index_bars(spark: SparkSession, path: str | list[str], run_date: date | None = None) -> DataFrame:
    """Typed index bars of a folder of daily files; headers may be in title or snake case."""
    return _for(run_date, index_rows_of(read_files(spark, path, run_date)))


def index_rows(cells: DataFrame) -> DataFrame:
    """Typed index bars from stored (file, modified, cells) rows; see ``index_rows_of``."""
    return _typed_index(_by_header(cells, INDEX_MARKER, _INDEX_NAMES))


def index_rows_of(files: DataFrame) -> DataFrame:
    """Typed index bars from whole files (file, modified, value).

    ``_corrupt`` marks rows with a measure that is text; such a measure is null.
    """
    return _typed_index(columns_of(files, INDEX_MARKER, _INDEX_NAMES))


def _typed_index(rows: DataFrame) -> DataFrame:
    measures = [c for c in INDEX_HEADERS.values() if c != "index"]
    corrupt = F.lit(False)
    for c in measures:
        corrupt = corrupt | number_is_corrupt(F.col(c))
    typed = rows.select(
        date_from_filename(F.col("file")).alias("date"),
        F.nullif(F.col("index"), F.lit("")).alias("index"),
        *[parse_number(F.col(c)).alias(c) for c in measures],
        "file",
        "modified",
        corrupt.alias("_corrupt"),
    )
    return typed.where("date IS NOT NULL")


def bars_for_date(df: DataFrame, run_date: date) -> DataFrame:
    """The rows that came from files of one run date."""
    return df.where(F.col("date") == F.lit(run_date))


def files_for_date(files: DataFrame, run_date: date, name: str = "file") -> DataFrame:
    """Files whose name holds the run date as YYYY_MM_DD or YYYY-MM-DD."""
    forms = [run_date.strftime("%Y_%m_%d"), run_date.strftime("%Y-%m-%d")]
    base = F.element_at(F.split(name, "/"), -1)
    is_csv = F.lower(base).endswith(".csv")
    return files.where(is_csv & (base.contains(forms[0]) | base.contains(forms[1])))


def stock_table(rows: DataFrame) -> DataFrame:
    """Stock bars in the stored layout, one row per (date, symbol): the one of the last delivery."""
    return align_to_schema(_of_last_delivery(rows, ("date", "symbol")), STOCK_BARS)


def index_table(rows: DataFrame) -> DataFrame:
    """Index bars in the stored layout, one row per (date, index): the one of the last delivery."""
    return align_to_schema(_of_last_delivery(rows, ("date", "index")), INDEX_BARS)


def _of_last_delivery(rows: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """One row per key: that of the greatest file name, part files of one folder by their time.

    Spark names part files at random, so of two deliveries into one folder the later one counts;
    if both have one time, the greater name does.
    """
    if "file" not in rows.columns:
        return rows
    modified = F.col("modified") if "modified" in rows.columns else F.lit(None).cast("bigint")
    order = F.struct(delivery_place(F.col("file")), modified, F.col("file"))
    return dedupe_bars(rows.withColumn("_delivery", order), "_delivery", keys)


def load_series(bars: DataFrame) -> DataFrame:
    """The columns the indicators read; rows without a symbol or close are left out.

    The order of a series is left to the window that uses it.
    """
    return bars.where("symbol IS NOT NULL AND close IS NOT NULL").select(
        normalize_date(F.col("date")).alias("date"),
        "symbol",
        *[coerce_numeric(F.col(c)).alias(c) for c in SERIES_MEASURES],
    )
