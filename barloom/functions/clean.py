"""Cleaning of raw cells, headers, file names and rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NO_RECORD = "no record found."
# Digits with an optional fraction and exponent; words such as nan, inf or 1d are not numbers.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SERIAL_HEADERS = ("S.No", "SNO", "sno", "Sno")

# Spellings of a header that stand for one column.
HEADER_SPELLINGS = {
    "close_minus_ltp": ("close - ltp", "close-ltp"),
    "close_minus_ltp_pct": ("close - ltp %", "close-ltp %", "close - ltp%", "close-ltp%"),
    "diff_pct": ("diff %", "diff%", "diff percent", "diff percentage"),
    "range_pct": ("range %", "range%", "range percent", "range percentage"),
    "vwap_pct": ("vwap %", "vwap%", "vwap percent", "vwap percentage"),
    "weeks_52_high": ("52 weeks high", "52weeks high", "52 week high", "52week high"),
    "weeks_52_low": ("52 weeks low", "52weeks low", "52 week low", "52week low"),
}
# Identifiers, as left by lower-casing and joining with "_", with another name.
HEADER_IDENTIFIERS = {
    "close_minus_ltp": ("close_ltp", "close_ltp_", "close_ltp__", "close_-_ltp", "close_-_ltp_"),
    "close_minus_ltp_pct": ("close_-_ltp_pct", "close_-_ltp_%", "close_ltp_pct", "close_ltp__pct"),
    "diff_pct": ("diff_%", "diff__", "diff__%"),
    "range_pct": ("range_%", "range__%"),
    "vwap_pct": ("vwap_%", "vwap__%"),
    "weeks_52_high": ("52_weeks_high", "52_weeks_high_", "52_weeks_high__"),
    "weeks_52_low": ("52_weeks_low", "52_weeks_low_", "52_weeks_low__"),
}


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends; ``trim`` would remove spaces only."""
    white = r"[\s\p{Z}\x1c-\x1f\x85]+"
    return F.regexp_replace(c, f"^{white}|{white}$", "")


def _lookup(c: Column, names: Mapping[str, tuple[str, ...]], otherwise: Column) -> Column:
    out = F.when(F.lit(False), c)
    for name, spellings in names.items():
        out = out.when(c.isin(*spellings), F.lit(name))
    return out.otherwise(otherwise)


def normalize_header(c: Column) -> Column:
    """Column identifier for a free-form header cell."""
    text = F.lower(strip(c))
    bare = F.regexp_replace(F.regexp_replace(text, "[.,]", ""), r"\s+", "_")
    named = _lookup(bare, HEADER_IDENTIFIERS, F.when(bare == "", F.lit("col")).otherwise(bare))
    named = F.when(named.rlike("^[0-9]"), F.concat(F.lit("_"), named)).otherwise(named)
    return _lookup(text, HEADER_SPELLINGS, named)


def rename_headers(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select the columns whose trimmed header is known, under their stored names."""
    found = {h.strip(): h for h in df.columns}
    return df.select(
        *[F.col(f"`{found[h]}`").alias(n) for h, n in names.items() if h in found],
        *[F.col(f"`{c}`") for c in df.columns if c.startswith("_")],
    )


def parse_number(c: Column) -> Column:
    """Number in a cell that may have thousands separators; anything else is null."""
    plain = F.replace(c, F.lit(","), F.lit(""))
    return F.when(plain.rlike(NUMBER), F.trim(plain).try_cast("double"))


def number_is_corrupt(c: Column) -> Column:
    """True for a non-empty cell that is not a number."""
    return F.coalesce((c != "") & parse_number(c).isNull(), F.lit(False))


def coerce_numeric(c: Column) -> Column:
    """Any column as a double; what is no number, and NaN, becomes null."""
    return nan_to_null(c.try_cast("double"))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def normalize_date(c: Column) -> Column:
    """Calendar day of a date, timestamp or date-like text; otherwise null."""
    return c.try_cast("date")


def date_from_name(stem: Column) -> Column:
    """Date in a file stem: YYYY-MM-DD, YYYY_MM_DD or YYYYMMDD; otherwise null.

    Month and day may have one digit when separated.
    """
    dashed = F.replace(stem, F.lit("_"), F.lit("-"))
    parts = F.regexp_extract(dashed, r"^(\d{4})-(\d{1,2})-(\d{1,2})$", 0)
    compact = F.regexp_replace(F.regexp_extract(stem, r"^\d{8}$", 0), r"^(.{4})(..)(..)$", "$1-$2-$3")
    return F.coalesce(parts.try_cast("date"), compact.try_cast("date"))


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def date_from_filename(path: Column) -> Column:
    """Date named by a file, or by the ``date=`` folder that holds it."""
    folder = F.regexp_extract(path, r"/date=([0-9_-]+)/[^/]*$", 1)
    return F.coalesce(date_from_name(file_stem(path)), date_from_name(folder))


def is_part_file(path: Column) -> Column:
    """True for one of the files that a Spark job writes into a folder."""
    return path.rlike("(^|/)part-[0-9]+[^/]*$")


def delivery_place(path: Column) -> Column:
    """Where a file was delivered: one name for all part files of a folder, else the file's own."""
    return F.regexp_replace(path, "(^|/)part-[0-9]+[^/]*$", "$1part-")


def delivery(path: Column) -> Column:
    """What a file was delivered with: one name for the part files that one job left in a folder (by
    the job's id in their names), else the file's own."""
    job = F.regexp_extract(path, "(?:^|/)part-[0-9]+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})[^/]*$", 1)
    return F.concat(delivery_place(path), job)


def drop_placeholder_rows(df: DataFrame, column: str = "symbol") -> DataFrame:
    """Drop rows without a symbol and the row that stands for an empty day."""
    c = F.col(column)
    return df.where(c.isNotNull() & (c != "") & (F.lower(strip(c)) != NO_RECORD))


def pad_ragged(cells: Column, width: int | Column) -> Column:
    """Cells filled up with nulls to ``width``; empty cells become null."""
    missing = F.greatest(F.lit(0), F.lit(width) - F.size(cells))
    filled = F.concat(cells, F.array_repeat(F.lit(None).cast("string"), missing))
    return F.transform(filled, lambda x: F.nullif(x, F.lit("")))


def keep_wellformed_rows(df: DataFrame, cells: str = "cells", header: str = "header",
                         at_least: bool = False) -> DataFrame:
    """Rows with as many cells as the header has, or at least as many."""
    size, need = F.size(cells), F.size(header)
    return df.where(size >= need if at_least else size == need)


def says_no_data(cells: str) -> Column:
    return F.exists(cells, lambda c: F.lower(c).rlike("no data found|no record found"))


def drop_no_data(
    rows: DataFrame, page: str = "page_id", cells: str = "cells", data: str = "row_no > 1"
) -> DataFrame:
    """Drop pages whose only data row (a row with ``data``) says that there is no data.

    Rows are counted per page with an aggregate, without a window over a page's rows.
    """
    empty = (
        rows.where(data)
        .groupBy(page)
        .agg(F.count(F.lit(1)).alias("n"), F.bool_or(says_no_data(cells)).alias("none"))
        .where("n = 1 AND none")
        .select(page)
    )
    return rows.join(empty, page, "left_anti")
