"""Jobs that keep the bar and indicator tables up to date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.clean import date_from_filename, delivery, delivery_place, is_part_file
from barloom.operators.blocks import BLOCK_ROWS
from barloom.operators.completeness import (
    dates_to_compute,
    existing_dates,
    newest_first_until,
    not_yet_loaded,
    restrict_to_dates,
)
from barloom.operators.dedupe import content_fingerprint, find_duplicates, one_file_per_date
from barloom.operators.indicators import compute, default_indicators
from barloom.plans.state import advance
from barloom.schema import INDEX_BARS, INDICATOR_COLUMNS, INDICATORS, KEYS, STOCK_BARS
from barloom.session import written
from barloom.sinks.tables import read_table, upsert, write_new_dates, write_upsert
from barloom.sources.bars import (
    INDEX_MARKER,
    STOCK_MARKER,
    bars_for_date,
    index_rows,
    index_table,
    is_header,
    load_series,
    read_index_bars,
    read_stock_bars,
    stock_rows,
    stock_table,
)
from barloom.sources.csv_files import read_cells


def compute_all_indicators(series: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """The 35 measures for every (date, symbol) of ``series``, in table order."""
    return compute(series, default_indicators(), rows=rows).select(*KEYS, *INDICATOR_COLUMNS)


def rows_to_backfill(
    bars: DataFrame,
    indicators: DataFrame,
    recompute_after_late: bool = True,
    after_warm_up: bool = True,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Freshly computed indicator rows that are missing or incomplete in ``indicators``.

    Nulls of a warm-up never fill, so by default they do not make a date incomplete.

    With ``recompute_after_late`` a bar that arrives late also refreshes the later rows of its
    series, which depend on it. Every row is computed from the whole history of its series; series
    without such a row are not computed.
    """
    series = load_series(bars)
    keys = series.select(*KEYS)
    targets = written(dates_to_compute(series, indicators, after_warm_up), "due-dates")
    due = keys.join(F.broadcast(targets), "date", "left_semi").groupBy("symbol").agg(F.lit(None).cast("date").alias("_since"))
    if recompute_after_late:
        late = keys.join(indicators.select(*KEYS), list(KEYS), "left_anti")
        due = due.unionByName(late.select("symbol", F.col("date").alias("_since")))
    # One row per series to compute; a null ``_since``: none of its bars is late.
    due = written(due.groupBy("symbol").agg(F.min("_since").alias("_since")), "due-series")
    computed = compute_all_indicators(series.join(due, "symbol", "left_semi"), rows)
    marked = computed.join(F.broadcast(targets.withColumn("_due", F.lit(True))), "date", "left").join(due, "symbol")
    return marked.where("_due OR date >= _since").select(*KEYS, *INDICATOR_COLUMNS)


def backfill_indicators(bars: DataFrame, indicators: DataFrame, **options) -> DataFrame:
    """The indicator table after a backfill; see ``rows_to_backfill`` for the options."""
    return upsert(rows_to_backfill(bars, indicators, **options), indicators)


def run_backfill(spark: SparkSession, bars_path: str, indicators_path: str, **options) -> None:
    bars = read_table(spark, bars_path, STOCK_BARS)
    done = read_table(spark, indicators_path, INDICATORS)
    write_upsert(rows_to_backfill(bars, done, **options), indicators_path, INDICATORS)


def daily_indicators(
    bars: DataFrame, indicators: DataFrame, run_date: date, rows: int = BLOCK_ROWS
) -> DataFrame:
    """Indicator rows of one date; none if it has no bars or its indicators exist already.

    Only symbols with a bar on the date are read, and only their rows up to it.
    """
    today = bars_for_date(load_series(bars), run_date)
    pending = today.join(F.broadcast(existing_dates(bars_for_date(indicators, run_date))), "date", "left_anti")
    history = load_series(bars).where(F.col("date") <= F.lit(run_date))
    history = history.join(pending.select("symbol"), "symbol", "left_semi")
    return bars_for_date(compute_all_indicators(history, rows), run_date)


def run_daily(
    spark: SparkSession, bars_path: str, indicators_path: str, run_date: date, state_path: str | None = None
) -> None:
    """Compute and store the indicator rows of one date, unless they exist.

    With ``state_path`` the series go on from their stored states (see ``plans.state``), so that only the
    date's bars are read, and bars of earlier dates that the states lack. If one of these is late,
    rows of dates that the table holds are brought up to date, too. The first run builds the states.
    """
    bars = read_table(spark, bars_path, STOCK_BARS)
    done = read_table(spark, indicators_path, INDICATORS)
    if state_path is None:
        write_upsert(daily_indicators(bars, done, run_date), indicators_path, INDICATORS)
        return
    change = advance(spark, bars_path, state_path, upto=run_date)
    present = existing_dates(done).where(F.col("date") != F.lit(run_date))
    held = bars_for_date(change.rows, run_date).unionByName(restrict_to_dates(change.rows, present))
    # Rows that the states include and the table lacks, as after a loss, take the whole history.
    today = bars_for_date(load_series(bars), run_date).select(*KEYS)
    lost = today.join(bars_for_date(done, run_date), list(KEYS), "left_anti").join(change.rows, list(KEYS), "left_anti")
    if not lost.isEmpty():
        whole = daily_indicators(bars.join(lost.select("symbol"), "symbol", "left_semi"), done.limit(0), run_date)
        held = held.unionByName(whole)
    write_upsert(held, indicators_path, INDICATORS)
    change.commit()


def run_refresh(spark: SparkSession, bars_path: str, indicators_path: str, state_path: str) -> int:
    """Store the indicator rows of all bars that the states at ``state_path`` lack.

    A bar that arrived late refreshes the later rows of its series, replayed from the newest state
    before it; history before that is not read. The first run computes everything and builds the
    states. Gives the number of series with late bars. A table that lost rows is mended by
    ``run_backfill``.
    """
    change = advance(spark, bars_path, state_path)
    write_upsert(change.rows, indicators_path, INDICATORS, stored=True)
    change.commit()
    return change.late


def ingest_today(
    spark: SparkSession,
    run_date: date,
    stock_files: str | None = None,
    stock_path: str | None = None,
    index_files: str | None = None,
    index_path: str | None = None,
) -> None:
    """Load the stock and the index files of one date, each if given, unless the date is loaded."""
    if stock_files:
        rows = read_stock_bars(spark, stock_files, run_date)
        write_new_dates(stock_table(rows), stock_path, STOCK_BARS)
    if index_files:
        rows = read_index_bars(spark, index_files, run_date)
        write_new_dates(index_table(rows), index_path, INDEX_BARS)


def ingest_history(
    spark: SparkSession,
    files: str | list[str],
    path: str,
    kind: str = "stock",
    cutoff: date | None = date(2020, 1, 1),
    skip_copies: bool = True,
) -> None:
    """Load a folder of daily files of one ``kind`` ("stock" or "index") into the table at ``path``.

    A delivery is a file, or all part files that one Spark job left in a folder. Of several jobs' into
    one folder the newest counts (by the time of its newest file, then by name). Deliveries without
    a date are left out and, with ``skip_copies``, those that repeat the content of one with a
    smaller name. Of the others one delivery counts per date, the last by name, with all its parts;
    dates up to ``cutoff`` and dates that the table holds are skipped. Files are parsed once and their
    cells written; all choices are made on one row per delivery.
    """
    to_rows, to_table, schema, marker = {
        "stock": (stock_rows, stock_table, STOCK_BARS, STOCK_MARKER),
        "index": (index_rows, index_table, INDEX_BARS, INDEX_MARKER),
    }[kind]
    file = F.col("file")
    cells = read_cells(spark, files).withColumns({"delivery": delivery(file), "place": delivery_place(file)})
    cells = written(cells, "cells")
    jobs = cells.groupBy("place", "delivery").agg(F.max("modified").alias("modified"))
    newest = jobs.groupBy("place").agg(F.max_by("delivery", F.struct("modified", "delivery")).alias("delivery"))
    newest = written(newest, "deliveries")
    names = newest.select("place")
    if skip_copies:
        # Every part has the header; it counts once, however many parts there are.
        current = cells.join(newest, ["place", "delivery"], "left_semi")
        repeated = is_part_file(file) & is_header(current, marker)
        prints = written(content_fingerprint(current, "place", once=repeated), "fingerprints")
        names = prints.select("place").join(find_duplicates(prints, "place"), "place", "left_anti")
    dated = names.withColumn("date", date_from_filename(F.col("place")))
    wanted = newest_first_until(one_file_per_date(dated, name="place"), cutoff)
    chosen = not_yet_loaded(wanted, read_table(spark, path, schema)).join(newest, "place")
    rows = cells.join(written(chosen, "chosen"), ["place", "delivery"], "left_semi").select("file", "modified", "cells")
    write_new_dates(to_table(to_rows(rows)), path, schema)
