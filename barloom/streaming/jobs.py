"""Streaming counterparts of the daily jobs."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from barloom.functions.clean import coerce_numeric
from barloom.operators.blocks import BLOCK_ROWS
from barloom.plans.state import advance
from barloom.schema import INDICATORS, KEYS, STOCK_BARS
from barloom.sinks.tables import read_table, write_new_dates, write_upsert
from barloom.sources.bars import stock_rows_of, stock_table
from barloom.sources.csv_files import stream_files

_STAGED = T.StructType(
    [*STOCK_BARS.fields, T.StructField("file", T.StringType()), T.StructField("modified", T.LongType())]
)
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_ingest(
    spark: SparkSession, files: str, table: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Load stock files that arrive below ``files`` into the bar table, each file once.

    The stream's checkpoint remembers the files; dates the table held before are skipped. A backlog
    is parsed in batches of ``files_per_batch`` files, whose rows are staged below the checkpoint;
    once all are taken, whole dates are loaded from there, so the borders of the batches do not
    matter. Rows staged by a run that failed are loaded by the next one. Returns the query when it
    has ended and the table is written.
    """
    raw = stream_files(spark, files, files_per_batch)
    staged = f"{checkpoint}/staged"

    def stage(batch: DataFrame, batch_id: int) -> None:
        # A batch that runs again after a failure replaces its rows.
        _stage(stock_rows_of(batch).withColumn("batch", F.lit(batch_id)), staged, "dynamic")

    query = (
        raw.writeStream.foreachBatch(stage)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rows = read_table(spark, staged, _STAGED)
    write_new_dates(stock_table(rows), table, STOCK_BARS)
    _stage(spark.createDataFrame([], _STAGED).withColumn("batch", F.lit(0)), staged, "static")
    return query


def _stage(rows: DataFrame, path: str, replace: str) -> None:
    """Write rows by batch; "dynamic" replaces their batches, "static" all that is staged."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", replace).partitionBy("batch").parquet(path)


def stream_indicators(
    spark: SparkSession, bars: str, indicators: str, checkpoint: str, rows: int = BLOCK_ROWS
) -> StreamingQuery:
    """Keep the indicator table current as rows are appended to the bar table.

    The states of the series lie beside the stream's checkpoint (see ``plans.state``). A batch goes on
    from them, so it reads the dates of its own rows, not their history; a series with a late bar is
    replayed from the newest state before that, and all its later rows are written anew. A batch
    that runs again after a failure gives the same table.
    """
    new_bars = spark.readStream.schema(STOCK_BARS).parquet(bars)

    def refresh(batch: DataFrame, _: int) -> None:
        keys = batch.where("close IS NOT NULL").select(*KEYS)
        change = advance(batch.sparkSession, bars, f"{checkpoint}/series", keys=keys, rows=rows)
        write_upsert(change.rows, indicators, INDICATORS, KEYS, stored=True)
        change.commit()

    return (
        new_bars.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class _Ewm(NamedTuple):
    """The mean, the rows since its last value, the number of values, and the last day of a series."""

    y: float | None = None
    gap: int = 0
    seen: int = 0
    last: date | None = None


class _Series:
    """A series' mean and the rows that wait."""

    def __init__(self, mean: _Ewm = _Ewm(), days: list[date] | None = None, xs: list[float | None] | None = None):
        self.mean = mean
        self.waiting: list[tuple[date, float | None]] = list(zip(days or [], xs or []))


class _EwmState(StatefulProcessor):
    """Carries an ``_Ewm`` per series; with ``reorder`` rows wait until the watermark has passed them.

    A key of the state is a group of series (see ``SERIES_GROUPS``), so that calls into the state
    store and frames are shared by its series.
    """

    def __init__(self, alpha: float, min_periods: int, reorder: bool):
        self.alpha, self.min_periods, self.reorder = alpha, min_periods, reorder

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getListState(
            "series", "symbol string, y double, gap long, seen long, last date, days array<date>, xs array<double>"
        )

    def _load(self) -> dict[str | None, _Series]:
        return {r[0]: _Series(_Ewm(*r[1:5]), r[5], r[6]) for r in self.state.get()}

    def _save(self, group: dict[str | None, _Series]) -> None:
        """Stores the group; a timer is set for the first day that waits."""
        rows = [
            (symbol, *s.mean, [d for d, _ in s.waiting], [x for _, x in s.waiting])
            for symbol, s in group.items()
            if s.waiting or s.mean.last is not None
        ]
        if rows:
            self.state.put(rows)
        first = min((d for s in group.values() for d, _ in s.waiting), default=None)
        if first is not None:
            self.handle.registerTimer(_milliseconds(first))

    def _advance(self, state: _Ewm, day: date, x: float | None) -> _Ewm:
        y, gap, seen, _ = state
        gap += 1
        if x is not None:
            weight = (1 - self.alpha) ** gap
            y = x if y is None else (weight * y + self.alpha * x) / (weight + self.alpha)
            gap, seen = 0, seen + 1
        return _Ewm(y, gap, seen, day)

    def _means(self, symbol: str | None, series: _Series, rows: list[tuple[date | None, float | None]], out: list) -> None:
        """Takes rows in the order of their days into the mean; those it is past come out as late."""
        state = series.mean
        for day, x in rows:
            late = day is None or (state.last is not None and day <= state.last)
            if not late:
                state = self._advance(state, day, x)
            out.append((symbol, day, x, None if late or state.seen < self.min_periods else state.y, late))
        series.mean = state

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # A batch holds the new rows of the series only; they are put in order before use.
        new: dict[str | None, list] = {}
        for frame in rows:
            symbols, days, xs = frame["symbol"], frame["date"], frame["x"]
            nulls = [pd.isna(c).tolist() for c in (symbols, days, xs)]
            for s, d, x, no_s, no_d, no_x in zip(symbols, days, xs.tolist(), *nulls):
                new.setdefault(None if no_s else s, []).append((None if no_d else d, None if no_x else x))
        group, out = self._load(), []
        for symbol, pairs in new.items():
            pairs.sort(key=_by_day)
            series = group.setdefault(symbol, _Series())
            if self.reorder:
                passed = series.mean.last
                late = [r for r in pairs if r[0] is None or (passed is not None and r[0] <= passed)]
                series.waiting += [r for r in pairs if not (r[0] is None or (passed is not None and r[0] <= passed))]
                pairs = late
            self._means(symbol, series, pairs, out)
        self._save(group)
        if out:
            yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        group, out = self._load(), []
        for symbol, series in group.items():
            due = [r for r in series.waiting if _milliseconds(r[0]) <= now]
            if due:
                series.waiting = [r for r in series.waiting if _milliseconds(r[0]) > now]
                self._means(symbol, series, sorted(due, key=_by_day), out)
        if out:
            self._save(group)
            yield _frame(out)

    def close(self) -> None:
        pass


def _by_day(row: tuple[date | None, float | None]) -> tuple:
    day, x = row
    return day is None, day or date.min, x is None, x or 0.0


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["symbol", "date", "x", "ewm", "late"])


def _milliseconds(day: date) -> int:
    return (day - date(1970, 1, 1)).days * 86_400_000


#: Days by which event times run ahead of the dates they stand for. Spark drops rows behind the
#: watermark; so far ahead none is, while timers, which are set for the dates, follow the watermark.
_AHEAD = 100 * 365
#: Groups by which the series of a stream are kept: the keys of its state. The number is part of a checkpoint.
SERIES_GROUPS = 4096


def stream_ewm(series: DataFrame, alpha: float, min_periods: int = 1, delay_days: int | None = None) -> DataFrame:
    """Weighted mean of a stream (symbol, date, x) of rows.

    Output: symbol, date, x, ewm, late. Without ``delay_days`` rows are used as they come, each
    batch in date order. With it a row waits until the newest date of the stream is that many days
    ahead of its own; rows that come up to then enter the mean in date order, whatever the order in
    which they came. State and waiting rows survive a restart.

    A row that is not after the last one used of its series cannot enter the mean; it is passed on at
    once with ``late`` set, to be recomputed by ``stream_indicators`` or a backfill. So is a row without
    a date and all but one of several rows of one day (the one of least x counts). A row waits in the
    state of its series, at most one per day of the delay. Needs the RocksDB state store; with
    ``delay_days`` the stream must have no watermark of its own.

    Scale: series are kept in SERIES_GROUPS groups by a hash of their symbol, so that a batch calls the
    state store once per group and not per series. A task holds the new and the waiting rows of one group.
    """
    schema = T.StructType.fromDDL("symbol string, date date, x double, ewm double, late boolean")
    rows = series.select("symbol", "date", coerce_numeric(F.col("x")).alias("x"))
    reorder = delay_days is not None
    if reorder:
        ahead = F.date_add("date", _AHEAD).cast("timestamp")
        rows = rows.withColumn("_clock", ahead).withWatermark("_clock", f"{_AHEAD + delay_days} days")
    rows = rows.withColumn("_group", F.pmod(F.xxhash64("symbol"), F.lit(SERIES_GROUPS)))
    return rows.groupBy("_group").transformWithStateInPandas(
        statefulProcessor=_EwmState(alpha, min_periods, reorder),
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime" if reorder else "None",
    )
