"""Stored states of series, from which a run goes on without reading their history.

A state table holds, per series, what the indicators of later rows need to know of the rows so far: the
last rows (as many as the longest window looks back) and the states of the weighted means and totals.
It is kept per epoch of ``EPOCH_DAYS`` calendar days: the folder of an epoch has, for every series, the
state behind its last row up to the epoch's end. So rows that follow what is stored need the newest
epoch only, and a bar that arrives late is replayed from the epoch before it.

    <state>/plan=<crc>/series/epoch=<n>     symbol, as_of, tail, scans
    <state>/plan=<crc>/keys/month=<yyyymm>  date, symbol: the rows that the states include
    <state>/plan=<crc>/days                 date, n_rows, at: bars of a day when it was last looked at

``plan`` stands for the set of indicators: with another set the states start anew.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.blocks import BLOCK_ROWS
from barloom.operators.indicators import Indicator, default_indicators, look_back, resume
from barloom.schema import KEYS, STOCK_BARS
from barloom.session import written
from barloom.sinks.tables import read_table, stored_counts
from barloom.sources.bars import SERIES_MEASURES, load_series

#: Calendar days of an epoch; a state is as long as some 200 rows, so epochs are much longer.
EPOCH_DAYS = 2048

_DATE, _TEXT, _NUMBER, _COUNT = T.DateType(), T.StringType(), T.DoubleType(), T.LongType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_ROW = _struct(date=_DATE, **dict.fromkeys(SERIES_MEASURES, _NUMBER))
_SCAN = _struct(scan=_TEXT, y=_NUMBER, gap=_COUNT, seen=_COUNT)
_SERIES = _struct(symbol=_TEXT, as_of=_DATE, tail=T.ArrayType(_ROW), scans=T.ArrayType(_SCAN), epoch=_COUNT)
_KEYS = _struct(date=_DATE, symbol=_TEXT, month=T.IntegerType())
_DAYS = _struct(date=_DATE, n_rows=_COUNT, at=T.TimestampType())


@dataclass(frozen=True)
class StateTable:
    """The states of one set of indicators below ``path``."""

    spark: SparkSession
    path: str
    indicators: Sequence[Indicator]
    epoch_days: int = EPOCH_DAYS

    @property
    def folder(self) -> str:
        scans = [repr(s) for i in self.indicators for s in (*i.scans, *i.scans2)]
        text = repr((scans, look_back(self.indicators), self.epoch_days))
        return f"{self.path.rstrip('/')}/plan={zlib.crc32(text.encode()):08x}"

    def series(self) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/series", _SERIES)

    def keys(self, dates: Sequence[date]) -> DataFrame:
        """(date, symbol) of the rows on ``dates`` that the states include."""
        months = sorted({100 * d.year + d.month for d in dates})
        keys = read_table(self.spark, f"{self.folder}/keys", _KEYS)
        return keys.where(F.col("month").isin(months) & _on(dates)).select(*KEYS) if dates else keys.select(*KEYS).limit(0)

    def add_keys(self, new: DataFrame) -> None:
        month = (100 * F.year("date") + F.month("date")).cast("int")
        new = new.withColumn("month", month).hint("rebalance", "month").sortWithinPartitions("month", "date")
        new.write.mode("append").partitionBy("month").parquet(f"{self.folder}/keys")

    def days(self) -> DataFrame:
        """(date, n_rows): the number of bars that each day had when it was last looked at."""
        seen = read_table(self.spark, f"{self.folder}/days", _DAYS)
        return seen.groupBy("date").agg(F.max_by("n_rows", "at").alias("known"))

    def add_days(self, counts: dict[date, int]) -> None:
        rows = self.spark.createDataFrame(list(counts.items()), "date date, n_rows long")
        rows.coalesce(1).withColumn("at", F.current_timestamp()).write.mode("append").parquet(f"{self.folder}/days")

    def epoch(self, day: Column) -> Column:
        return F.floor(F.unix_date(day) / self.epoch_days).cast("bigint")

    def epochs(self) -> list[int]:
        """The stored epochs, one per EPOCH_DAYS of the calendar; only folder names are needed."""
        return sorted(r[0] for r in self.series().select("epoch").distinct().collect())


def changed_days(table: StateTable, bars_path: str, upto: date | None = None) -> dict[date, int]:
    """Days up to ``upto`` whose number of bars is not that of the last look, with that number.

    The numbers come from the files' footers; days are bounded by the calendar.
    """
    counts = stored_counts(table.spark, bars_path, STOCK_BARS)
    if upto is not None:
        counts = counts.where(F.col("date") <= F.lit(upto))
    counts = counts.join(F.broadcast(table.days()), "date", "left")
    return {r["date"]: r["n_rows"] for r in counts.where("date IS NOT NULL AND (known IS NULL OR known <> n_rows)").collect()}


def _on(dates: Sequence[date]) -> Column:
    """Rows of the dates, as a condition that prunes folders."""
    if not dates:
        return F.lit(False)
    if len(dates) <= 100:
        return F.col("date").isin(list(dates))
    return F.col("date").between(min(dates), max(dates)) & F.col("date").isin(list(dates))


def new_keys(table: StateTable, bars: DataFrame, dates: Sequence[date]) -> DataFrame:
    """(date, symbol) of the bars on ``dates`` that the states do not include."""
    series = load_series(bars.where(_on(dates)))
    return series.select(*KEYS).join(table.keys(dates), list(KEYS), "left_anti")


@dataclass(frozen=True)
class Advance:
    """What a run changed.

    ``rows`` are the indicator rows of every series from its first new bar on, read from a written
    table; ``late`` counts the series with a new bar that is not behind all stored ones. The states hold
    the run only after ``commit``, to be called when the rows are where they belong.
    """

    rows: DataFrame
    late: int
    commit: Callable[[], None]


def advance(
    spark: SparkSession,
    bars_path: str,
    state_path: str,
    keys: DataFrame | None = None,
    upto: date | None = None,
    indicators: Sequence[Indicator] | None = None,
    rows: int = BLOCK_ROWS,
    epoch_days: int = EPOCH_DAYS,
) -> Advance:
    """Takes new bars into the states and gives the indicator rows that this adds or changes.

    New are ``keys`` (date, symbol), by default all bars up to ``upto`` that the states lack. A series
    whose new rows all follow its state goes on from it: only the folders of the new dates and the
    newest epoch are read. One with a late row, or a row given again, goes on from the newest state
    before its first new row, and its bars from there on are read. A series without a state starts
    with its first bar. Rows without a symbol, a date or a close count as none; with several bars of
    one key one of them counts, the greatest by its measures.

    A run that fails before it commits is repeated as it was. One that fails while it commits finds some
    states ahead of its rows, takes these for late ones and gives the same result again. Runs on one
    state table must not overlap.
    """
    indicators = list(indicators or default_indicators())
    table = StateTable(spark, state_path, indicators, epoch_days)
    stored = read_table(spark, bars_path, STOCK_BARS)
    looked_at: dict[date, int] = {}
    if keys is None:
        looked_at = changed_days(table, bars_path, upto)
        keys = new_keys(table, stored, sorted(looked_at))
    else:
        keys = keys.where("date IS NOT NULL AND symbol IS NOT NULL").select(*KEYS).distinct()
    keys = written(keys, "state-new")
    since = keys.groupBy("symbol").agg(F.min("date").alias("since"), F.max("date").alias("last"))
    since = written(since, "state-since")
    outputs = list(dict.fromkeys(o for i in indicators for o in i.outputs))
    bars = load_series(stored)
    days = sorted(r[0] for r in keys.select("date").distinct().collect())
    if not days:
        empty = _struct(date=_DATE, symbol=_TEXT, **dict.fromkeys(outputs, _NUMBER))
        return Advance(spark.createDataFrame([], empty), 0, lambda: table.add_days(looked_at) if looked_at else None)
    fresh = bars.where(_on(days)).join(keys, list(KEYS), "left_semi")
    entering, late, back = _entering(table, since)
    if late:
        # Late series are read from the state they go on from, as far as they were computed.
        behind = written(entering.where("late").select("symbol", "as_of", "upto"), "state-late")
        old = bars if back is None else bars.where(F.col("date") > F.lit(back))
        again = old.join(behind, "symbol").where("(as_of IS NULL OR date > as_of) AND date <= upto")
        fresh = fresh.join(behind.select("symbol"), "symbol", "left_anti").unionByName(again.drop("as_of", "upto"))
    series = written(_with_tails(table, fresh, entering), "state-rows")
    done = resume(series, entering.select("symbol", "scans").where("scans IS NOT NULL"), indicators, "_tail", "_keep", rows=rows)
    done = written(done, "state-done")
    changed = done.join(since.select("symbol", "since"), "symbol").where("date >= since").select(*KEYS, *outputs)

    def commit() -> None:
        _write_states(table, _new_states(table, series, done))
        # Written first, as the keys of these days are read and added to.
        table.add_keys(written(keys.join(table.keys(days), list(KEYS), "left_anti"), "state-keys"))
        if looked_at:
            table.add_days(looked_at)

    return Advance(changed, late, commit)


def _entering(table: StateTable, since: DataFrame) -> tuple[DataFrame, int, date | None]:
    """Per series of ``since`` the newest state before its first new row (null without one), whether it
    has rows behind that are stored (``late``) and up to where; the number of late series and the
    oldest state one of them goes on from (None: from the first bar)."""
    first = since.agg(F.min(table.epoch(F.col("since")))).first()[0]
    stored = table.epochs()
    needed = [e for e in stored if first is not None and e >= max([x for x in stored if x < first], default=first)]
    states = table.series().where(F.col("epoch").isin(needed)) if needed else table.series().limit(0)
    # Which state each series goes on from is settled on two narrow columns.
    known = states.select("symbol", "as_of", "epoch").join(since, "symbol")
    picked = known.groupBy("symbol").agg(
        F.max(F.when(F.col("as_of") < F.col("since"), F.struct("as_of", "epoch"))).alias("best"),
        F.max("as_of").alias("reached"),
    )
    picked = since.join(picked, "symbol", "left").select(
        "symbol", F.col("best.epoch").alias("epoch"), F.coalesce(F.col("reached") >= F.col("since"), F.lit(False)).alias("late"),
        F.greatest("reached", "last").alias("upto"),
    )
    picked = written(picked, "state-picked")
    chosen = [r[0] for r in picked.where("epoch IS NOT NULL").select("epoch").distinct().collect()]
    full = states.where(F.col("epoch").isin(chosen)) if chosen else states
    entering = written(picked.join(full, ["symbol", "epoch"], "left"), "state-entering")
    late = entering.where("late").agg(F.count(F.lit(1)), F.count("as_of"), F.min("as_of")).first()
    return entering, late[0], late[2] if late[0] == late[1] else None


def _with_tails(table: StateTable, fresh: DataFrame, entering: DataFrame) -> DataFrame:
    """The new rows behind the stored ones: ``_tail`` marks the latter, ``_keep`` the last row of an epoch,
    and ``_until`` is the first epoch whose end has the row no longer among its last ones.

    A series is ordered as a whole here; it has at most one row per calendar day.
    """
    columns = ["symbol", "date", *SERIES_MEASURES]
    fresh = fresh.where("symbol IS NOT NULL AND date IS NOT NULL")
    one = fresh.groupBy(*KEYS).agg(F.max(F.struct(*SERIES_MEASURES)).alias("m"))
    one = one.select(*KEYS, "m.*").select(*columns, F.lit(False).alias("_tail"))
    tails = entering.select("symbol", F.inline("tail")).select(*columns, F.lit(True).alias("_tail"))
    w = Window.partitionBy("symbol").orderBy("date")
    epoch = table.epoch(F.col("date"))
    beyond = F.lead("_epoch", look_back(table.indicators)).over(w)
    return (
        one.unionByName(tails)
        .withColumn("_epoch", epoch)
        .withColumns({"_next": F.lead("_epoch").over(w), "_until": beyond})
        .withColumn("_keep", ~F.col("_tail") & (F.col("_next").isNull() | (F.col("_next") != F.col("_epoch"))))
        .drop("_next")
    )


def _new_states(table: StateTable, series: DataFrame, done: DataFrame) -> DataFrame:
    """The state behind the last row of every epoch of ``done``: symbol, as_of, tail, scans, epoch."""
    ends = done.where("scans IS NOT NULL").select("symbol", F.col("date").alias("as_of"), "scans", table.epoch(F.col("date")).alias("epoch"))
    # A row is among the last ones at the ends of the epochs from its own to ``_until``, exclusive.
    row = F.struct("date", *SERIES_MEASURES).alias("row")
    spans = series.select("symbol", F.col("_epoch"), "_until", row)
    placed = spans.join(ends.select("symbol", "epoch"), "symbol").where("epoch >= _epoch AND (_until IS NULL OR epoch < _until)")
    tails = placed.groupBy("symbol", "epoch").agg(F.sort_array(F.collect_list("row")).alias("tail"))
    return ends.join(tails, ["symbol", "epoch"]).select(*_SERIES.fieldNames())


def _write_states(table: StateTable, states: DataFrame) -> None:
    """Puts new states into their epochs and all later ones; an epoch that is new starts with the
    states of the one before."""
    states = written(states, "state-states")
    run = sorted(r[0] for r in states.select("epoch").distinct().collect())
    if not run:
        return
    stored = table.epochs()
    targets = sorted({*run, *[e for e in stored if e > run[0]]})
    # Each series' state holds until its next one in this run.
    w = Window.partitionBy("symbol").orderBy("epoch")
    places = F.array(*[F.lit(e).cast("bigint") for e in targets])
    own = states.withColumn("_next", F.lead("epoch").over(w)).withColumn(
        "_at", F.explode(F.filter(places, lambda e: (e >= F.col("epoch")) & (F.col("_next").isNull() | (e < F.col("_next")))))
    )
    own = own.select("symbol", "as_of", "tail", "scans", F.col("_at").alias("epoch"))
    parts = [own]
    for e in targets:
        base = max([x for x in stored if x <= e], default=None)
        if base is not None:
            kept = table.series().where(F.col("epoch") == F.lit(base)).withColumn("epoch", F.lit(e).cast("bigint"))
            parts.append(kept.join(own.where(F.col("epoch") == F.lit(e)).select("symbol"), "symbol", "left_anti"))
    new = parts[0]
    for part in parts[1:]:
        new = new.unionByName(part)
    new = written(new, "state-epochs")
    (
        new.hint("rebalance", "epoch")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("epoch")
        .parquet(f"{table.folder}/series")
    )
