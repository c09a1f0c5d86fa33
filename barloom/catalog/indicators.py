"""Indicator queries over the derived bars, and their SQL."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.catalog.bars import BARS_SQL, bars
from barloom.catalog.registry import QUERIES, ORACLES, query, rounded, rounded_sql
from barloom.functions.series import TYPICAL_PRICE, SeriesWindow, add_columns, true_range
from barloom.operators import indicators as I
from barloom.operators.completeness import incomplete_dates, incomplete_dates_after_warm_up
from barloom.operators.extension import apply_per_series, fold_per_series
from barloom.operators.recurrence import ANYWHERE, NEVER, Ewm, Total, ewm, span_alpha, wilder_alpha
from barloom.plans.incremental import (
    backfill_indicators,
    compute_all_indicators,
    daily_indicators,
    rows_to_backfill,
    run_backfill,
    run_daily,
    run_refresh,
)
from barloom.schema import INDICATOR_COLUMNS, INDICATORS, STOCK_BARS, align_to_schema
from barloom.session import new_folder, written
from barloom.sinks.buckets import by_series, create_series_table, read_series_table, write_upsert_series
from barloom.sinks.tables import read_table, write_new_dates, write_upsert
from barloom.sources.bars import load_series

# Blocks short enough that the series of every test scale are split.
SMALL_BLOCKS = 512

W = "(partition by symbol order by date)"


def _rows(n: int) -> str:
    return f"over (partition by symbol order by date rows between {n - 1} preceding and current row)"


def _running() -> str:
    return "over (partition by symbol order by date rows between unbounded preceding and current row)"


def _ewm(x: str, a: str, t: str, min_periods: int = 1) -> str:
    """Closed form for a series without gaps whose first value is at row ``t = 0``."""
    term = f"case when {t} = 0 then {x} when {t} > 0 then {a} * {x} * pow(1 - {a}, -{t}) end"
    return f"case when {t} >= {min_periods - 1} then pow(1 - {a}, {t}) * sum({term}) {_running()} end"


def _mean(c: str, n: int) -> str:
    return f"case when t >= {n - 1} then avg({c}) {_rows(n)} end"


INDICATOR_SQL = f"""
with {BARS_SQL.strip()},
s0 as (
  select *, (high + low + close) / 3 as tp, row_number() over {W} - 1 as t,
         lag(close) over {W} as pc, lag(high) over {W} as ph, lag(low) over {W} as pl
  from bars
),
s1 as (
  select *, close - pc as delta, tp - lag(tp) over {W} as dtp,
         greatest(high - low, coalesce(abs(high - pc), 0), coalesce(abs(low - pc), 0)) as tr
  from s0
),
s2 as (
  select *, greatest(delta, 0) as gain, greatest(-delta, 0) as loss,
         case when high - ph > pl - low and high - ph > 0 then high - ph else 0 end as pdm,
         case when pl - low > high - ph and pl - low > 0 then pl - low else 0 end as mdm,
         case when dtp > 0 then tp * vol else 0 end as fup,
         case when dtp < 0 then tp * vol else 0 end as fdown,
         vol * (case when dtp > 0 then 1 else -1 end) * abs(dtp) as vf,
         vol * coalesce(sign(delta), 0) as step
  from s1
),
s3 as (
  select *,
    {_ewm('gain', '(1.0/14)', '(t-1)', 14)} as g14, {_ewm('loss', '(1.0/14)', '(t-1)', 14)} as l14,
    {_ewm('close', '(2.0/10)', 't')} as ema_9, {_ewm('close', '(2.0/13)', 't')} as ema_12,
    {_ewm('close', '(2.0/27)', 't')} as ema_26, {_ewm('close', '(2.0/201)', 't')} as ema_200,
    {_ewm('tr', '(1.0/14)', 't', 14)} as atr_14,
    {_ewm('pdm', '(1.0/14)', 't', 14)} as p14, {_ewm('mdm', '(1.0/14)', 't', 14)} as m14,
    {_ewm('vf', '(2.0/35)', '(t-1)')} as vf34, {_ewm('vf', '(2.0/56)', '(t-1)')} as vf55,
    sum(step) {_running()} as obv,
    case when t >= 8 then max(high) {_rows(9)} end as hh9, case when t >= 8 then min(low) {_rows(9)} end as ll9,
    case when t >= 13 then max(high) {_rows(14)} end as hh14, case when t >= 13 then min(low) {_rows(14)} end as ll14,
    case when t >= 21 then max(high) {_rows(22)} end as hh22, case when t >= 21 then min(low) {_rows(22)} end as ll22,
    case when t >= 25 then max(high) {_rows(26)} end as hh26, case when t >= 25 then min(low) {_rows(26)} end as ll26,
    case when t >= 51 then max(high) {_rows(52)} end as hh52, case when t >= 51 then min(low) {_rows(52)} end as ll52,
    {_mean('tr', 22)} as tr22, {_mean('tp', 20)} as tp20, list(tp) {_rows(20)} as tps,
    {', '.join(f"{_mean('close', n)} as sma_{n}" for n in (5, 10, 20, 50, 200))},
    case when t >= 19 then stddev_pop(close) {_rows(20)} end as sd20,
    case when t >= 19 then regr_slope(close, t) {_rows(20)} end as slope_20,
    case when t >= 13 then sum(fup) {_rows(14)} end as up14,
    case when t >= 13 then sum(fdown) {_rows(14)} end as down14,
    close / lag(close, 5) over {W} - 1 as momentum_5,
    100 * (close / lag(close, 12) over {W} - 1) as roc
  from s2
),
s4 as (
  select *, ema_12 - ema_26 as macd_line,
    100 - 100 / (1 + g14 / nullif(l14, 0)) as rsi_14,
    100 * (close - ll14) / nullif(hh14 - ll14, 0) as stoch_k,
    -100 * (hh14 - close) / nullif(hh14 - ll14, 0) as williams_r,
    (tp - tp20) / nullif(0.015 * list_sum(list_transform(tps, lambda x: abs(x - tp20))) / 20, 0) as cci_20,
    100 * p14 / nullif(atr_14, 0) as plus_di, 100 * m14 / nullif(atr_14, 0) as minus_di,
    sma_20 + 2 * sd20 as bb_upper, sma_20 - 2 * sd20 as bb_lower,
    (hh9 + ll9) / 2 as ichimoku_conversion, (hh26 + ll26) / 2 as ichimoku_base,
    hh22 - 3 * tr22 as chandelier_long, ll22 + 3 * tr22 as chandelier_short,
    coalesce(100 - 100 / (1 + up14 / nullif(down14, 0)), 50) as mfi_14, vf34 - vf55 as kvo,
    roc - lag(roc, 3) over {W} as acceleration
  from s3
),
s5 as (
  select *, 100 * abs(plus_di - minus_di) / nullif(plus_di + minus_di, 0) as dx,
    {_ewm('macd_line', '(2.0/10)', 't')} as macd_signal,
    case when t >= 15 then avg(stoch_k) {_rows(3)} end as stoch_d,
    lag((ichimoku_conversion + ichimoku_base) / 2, 26) over {W} as ichimoku_span_a,
    lag((hh52 + ll52) / 2, 26) over {W} as ichimoku_span_b
  from s4
),
ind as (
  select *, macd_line - macd_signal as macd_hist,
    {_ewm('dx', '(1.0/14)', '(t-13)', 14)} as adx_14
  from s5
)
"""

# Recurrences and ratios are compared to 4 digits, window columns to 6.
_FAMILIES = {
    "rsi": (lambda: [I.rsi()], 4),
    "macd": (lambda: [I.macd()], 4),
    "stochastic": (lambda: [I.stochastic()], 6),
    "cci": (lambda: [I.cci()], 6),
    "williams_r": (lambda: [I.williams_r()], 6),
    "momentum": (lambda: [I.momentum()], 6),
    "sma": (lambda: [I.sma(n) for n in (5, 10, 20, 50, 200)], 6),
    "ema": (lambda: [I.ema(n) for n in (9, 12, 26, 200)], 4),
    "adx": (lambda: [I.adx()], 4),
    "slope": (lambda: [I.slope()], 6),
    "acceleration": (lambda: [I.acceleration()], 6),
    "atr": (lambda: [I.atr()], 4),
    "bollinger": (lambda: [I.bollinger()], 4),
    "ichimoku": (lambda: [I.ichimoku()], 6),
    "chandelier_exit": (lambda: [I.chandelier_exit()], 6),
    "obv": (lambda: [I.obv()], 4),
    "mfi": (lambda: [I.mfi()], 4),
    "kvo": (lambda: [I.kvo()], 4),
}
_OUTPUTS = {
    "rsi": ["rsi_14"],
    "macd": ["macd_line", "macd_signal", "macd_hist"],
    "stochastic": ["stoch_k", "stoch_d"],
    "cci": ["cci_20"],
    "williams_r": ["williams_r"],
    "momentum": ["momentum_5"],
    "sma": ["sma_5", "sma_10", "sma_20", "sma_50", "sma_200"],
    "ema": ["ema_9", "ema_12", "ema_26", "ema_200"],
    "adx": ["adx_14", "plus_di", "minus_di"],
    "slope": ["slope_20"],
    "acceleration": ["acceleration"],
    "atr": ["atr_14"],
    "bollinger": ["bb_upper", "bb_lower"],
    "ichimoku": ["ichimoku_conversion", "ichimoku_base", "ichimoku_span_a", "ichimoku_span_b"],
    "chandelier_exit": ["chandelier_long", "chandelier_short"],
    "obv": ["obv"],
    "mfi": ["mfi_14"],
    "kvo": ["kvo"],
}


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_series(bars(spark, sf_dir))


def _family(name: str):
    make, digits = _FAMILIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(I.compute(_series(spark, sf_dir), make()), _OUTPUTS[name], digits)

    return run


for _name, (_make, _digits) in _FAMILIES.items():
    QUERIES[_name] = _family(_name)
    ORACLES[_name] = f"{INDICATOR_SQL} select {rounded_sql(_OUTPUTS[_name], _digits)} from ind"

# sma_200 and span B land on ties of the fifth digit, so their kind is compared to 6 digits.
DIGITS = {c: 6 if c.startswith(("sma_", "ichimoku_")) else 4 for c in INDICATOR_COLUMNS}
ALL_SQL = f"{INDICATOR_SQL} select {rounded_sql(INDICATOR_COLUMNS, DIGITS)} from ind"


@query("all_indicators", ALL_SQL)
def all_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(compute_all_indicators(_series(spark, sf_dir)), INDICATOR_COLUMNS, DIGITS)


@query("all_indicators_in_blocks", ALL_SQL)
def all_indicators_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result with every series split into short blocks."""
    return rounded(compute_all_indicators(_series(spark, sf_dir), SMALL_BLOCKS), INDICATOR_COLUMNS, DIGITS)


@query("sma_in_blocks", ORACLES["sma"])
def sma_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = [I.sma(n) for n in (5, 10, 20, 50, 200)]
    return rounded(I.compute(_series(spark, sf_dir), wanted, rows=SMALL_BLOCKS), _OUTPUTS["sma"], 6)


@query("ichimoku_in_blocks", ORACLES["ichimoku"])
def ichimoku_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = I.compute(_series(spark, sf_dir), [I.ichimoku()], rows=SMALL_BLOCKS)
    return rounded(done, _OUTPUTS["ichimoku"], 6)


_LONG_OUT = ["cci_200", "slope_500", "stoch_k", "williams_r", "bb_upper"]
_LONG_SQL = f"""
with {BARS_SQL.strip()}, s as (select *, (high + low + close) / 3 as tp, row_number() over {W} - 1 as t from bars),
w as (select *, avg(tp) {_rows(200)} as m, list(tp) {_rows(200)} as tps, max(high) {_rows(250)} as hh, min(low) {_rows(250)} as ll,
  regr_slope(close, t) {_rows(500)} as slope, avg(close) {_rows(150)} as mid, stddev_pop(close) {_rows(150)} as dev from s),
e as (select date, symbol,
  case when t >= 199 then (tp - m) / nullif(0.015 * list_avg(list_transform(tps, lambda x: abs(x - m))), 0) end as cci_200,
  case when t >= 499 then slope end as slope_500,
  case when t >= 249 then 100 * (close - ll) / nullif(hh - ll, 0) end as stoch_k,
  case when t >= 249 then -100 * (hh - close) / nullif(hh - ll, 0) end as williams_r,
  case when t >= 149 then mid + 2 * dev end as bb_upper from w)
select {rounded_sql(_LONG_OUT, 4)} from e"""


@query("long_periods", _LONG_SQL)
def long_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicators whose frames hold hundreds of rows."""
    wanted = [I.cci(200), I.slope(500), I.stochastic(250), I.williams_r(250), I.bollinger(150)]
    return rounded(I.compute(_series(spark, sf_dir), wanted), _LONG_OUT, 4)


_CUT, _LATE = date(2000, 1, 1), date(2001, 10, 1)
_EWM_OUT = ["ema_200", "wilder", "volume"]
_EWM_SQL = f"""
with {BARS_SQL.strip()}, s as (select *, row_number() over {W} - 1 as t from bars),
e as (select *, {_ewm('close', '(2.0/201)', 't')} as ema_200, {_ewm('high', '(1.0/14)', 't', 14)} as wilder,
             sum(vol) {_running()} as volume from s)
select {rounded_sql(_EWM_OUT, 4)} from e"""


@query("ewm", _EWM_SQL)
def ewm_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scans = [
        Ewm("ema_200", "close", span_alpha(200), nulls=NEVER),
        Ewm("wilder", "high", wilder_alpha(14), 14, ANYWHERE),
        Total("volume", "vol"),
    ]
    return rounded(ewm(_series(spark, sf_dir), scans, rows=SMALL_BLOCKS), _EWM_OUT, 4)


# A mean that exists only at every third row of a series: the closed form carries the weights
# of the skipped rows, which are (1-a)^3 between two values.
_GAP_SQL = f"""
with {BARS_SQL.strip()}, s as (select *, row_number() over {W} - 1 as t from bars),
v as (select *, (t // 3) as k, pow(1 - 0.1, 3) / (pow(1 - 0.1, 3) + 0.1) as a0 from s),
e as (select *, pow(a0, k) * sum(case when t = 0 then close when t % 3 = 0
        then 0.1 / (pow(1 - 0.1, 3) + 0.1) * close * pow(a0, -k) end) {_running()} as gapped from v)
select {rounded_sql(['gapped'], 4)} from e"""


@query("ewm_with_gaps", _GAP_SQL)
def ewm_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weighted mean of a column that is null on two of three rows."""
    w = SeriesWindow()
    rows = add_columns(_series(spark, sf_dir), {"t": f"row_number() {w.over()} - 1"})
    rows = add_columns(rows, {"x": "CASE WHEN t % 3 = 0 THEN close END"})
    return rounded(ewm(rows, [Ewm("gapped", "x", 0.1)], rows=SMALL_BLOCKS), ["gapped"], 4)


@query("true_range", f"{INDICATOR_SQL} select {rounded_sql(['tr'], 6)} from ind")
def true_range_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_columns(_series(spark, sf_dir), {"prev": SeriesWindow().lag("close")})
    return rounded(add_columns(rows, {"tr": true_range("prev")}), ["tr"], 6)


@query("typical_price", f"{INDICATOR_SQL} select {rounded_sql(['tp'], 6)} from ind")
def typical_price_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(add_columns(_series(spark, sf_dir), {"tp": TYPICAL_PRICE}), ["tp"], 6)


_SERIES_OUT = ["open", "high", "low", "close", "ltp", "vol"]


@query("load_series", f"with {BARS_SQL.strip()} select {rounded_sql(_SERIES_OUT, 4)} from bars")
def load_series_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_series(spark, sf_dir), _SERIES_OUT, 4)


@query(
    "series_order",
    f"with {BARS_SQL.strip()} select {rounded_sql(['close'], 4)} from bars order by symbol, date",
)
def series_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_series(spark, sf_dir).orderBy("symbol", "date"), ["close"], 4)


_RANGE_SQL = f"with {BARS_SQL.strip()} select symbol, count(*) as n, round(max(high) - min(low), 4) as spread from bars group by symbol"


@query("apply_per_series", _RANGE_SQL)
def apply_per_series_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    def spread(pdf):
        out = pdf[["symbol"]].head(1).copy()
        out["n"] = len(pdf)
        out["spread"] = round(pdf["high"].max() - pdf["low"].min(), 4)
        return out

    return apply_per_series(_series(spark, sf_dir), spread, "symbol string, n bigint, spread double")


@query(
    "apply_per_series_in_blocks",
    f"with {BARS_SQL.strip()}, s as (select *, row_number() over {W} - 1 as t from bars),"
    f" e as (select *, {_mean('close', 5)} as mean from s) select {rounded_sql(['mean'], 4)} from e",
)
def apply_in_blocks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's function that looks four rows back, on series cut into short blocks."""

    def mean(pdf):
        return pdf[["date", "symbol"]].assign(mean=pdf["close"].rolling(5).mean())

    schema = "date date, symbol string, mean double"
    done = apply_per_series(_series(spark, sf_dir), mean, schema, lookback=4, rows=SMALL_BLOCKS)
    return rounded(done, ["mean"], 4)


_FOLD_SQL = f"""with {BARS_SQL.strip()}, e as (select date, symbol, close / max(close) {_running()} - 1 as drawdown,
  min(date) {_running()} as since from bars)
select {rounded_sql(['drawdown'], 6)}, cast(since as varchar) as since from e"""


@query("fold_per_series", _FOLD_SQL)
def fold_per_series_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loss since the highest close so far, a state carried through every series."""

    def step(state, frame):
        top, since = state
        since = since or frame["date"].iloc[0]
        tops = frame["close"].cummax().clip(lower=top)
        out = frame[["date", "symbol"]].assign(drawdown=frame["close"] / tops - 1, since=since)
        return (tops.iloc[-1], since), out

    schema = "date date, symbol string, drawdown double, since date"
    done = fold_per_series(_series(spark, sf_dir), lambda: (0.0, None), step, schema)
    return rounded(done, ["drawdown"], 6, ["symbol", F.col("since").cast("string").alias("since")])


# -- tables by series -------------------------------------------------------------------


def _series_table(spark: SparkSession, rows: DataFrame) -> str:
    name = f"barloom_{uuid.uuid4().hex}"
    create_series_table(rows, name, new_folder(spark, "by-series"), _BUCKETS)
    return name


_BUCKETS = 16


@query("indicators_by_series", ALL_SQL)
def indicators_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables are stored by symbol: early rows, then those that a backfill of it all adds."""
    stored = read_series_table(spark, _series_table(spark, align_to_schema(bars(spark, sf_dir), STOCK_BARS)))
    early = compute_all_indicators(load_series(stored.where(F.col("date") < F.lit(_CUT))))
    name = _series_table(spark, early)
    with by_series(spark):
        due = written(rows_to_backfill(stored, read_series_table(spark, name)), "due")
    write_upsert_series(due, name)
    return rounded(read_series_table(spark, name), INDICATOR_COLUMNS, DIGITS)


# -- incremental ------------------------------------------------------------------------

_PROBE_NULL = (
    "rsi_14 is null or stoch_k is null or cci_20 is null or williams_r is null or sma_200 is null"
    " or ema_9 is null or ema_200 is null"
)
_PROBES = lambda: [I.rsi(), I.stochastic(), I.cci(), I.williams_r(), I.sma(200), I.ema(9), I.ema(200)]


@query(
    "incomplete_dates",
    f"{INDICATOR_SQL} select distinct cast(date as varchar) as date from ind where {_PROBE_NULL}",
)
def incomplete_dates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = I.compute(_series(spark, sf_dir), _PROBES())
    return incomplete_dates(done).select(F.col("date").cast("string").alias("date"))


_WARM_NULL = " or ".join(
    f"({c} is null and t >= {n})"
    for c, n in dict(rsi_14=14, stoch_k=13, cci_20=19, williams_r=13, sma_200=199).items()
)


@query(
    "incomplete_dates_after_warm_up",
    f"{INDICATOR_SQL} select distinct cast(date as varchar) as date from"
    f" (select * replace (case when close > 104000 then null else sma_200 end as sma_200) from ind)"
    f" where {_WARM_NULL}",
)
def incomplete_dates_after_warm_up_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored means of days with a very high close are lost and have to be found."""
    bar_table = bars(spark, sf_dir)
    done = I.compute(load_series(bar_table), _PROBES())
    done = done.join(bar_table.select("date", "symbol", "close"), ["date", "symbol"])
    done = done.withColumn("sma_200", F.when(F.col("close") <= 104000, F.col("sma_200")))
    dates = incomplete_dates_after_warm_up(done)
    return dates.select(F.col("date").cast("string").alias("date"))


@query("backfill_indicators", ALL_SQL)
def backfill_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table computed up to a date is completed after the later bars have arrived."""
    bar_table = bars(spark, sf_dir)
    early = load_series(bar_table.where(F.col("date") < F.lit(_CUT)))
    done = written(compute_all_indicators(early), "indicators")
    return rounded(backfill_indicators(bar_table, done), INDICATOR_COLUMNS, DIGITS)


@query("run_backfill", ALL_SQL)
def run_backfill_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job on stored tables, run before and after the last bars arrive; the whole table."""
    stored, path = new_folder(spark, "bars"), new_folder(spark, "indicators")
    for part in (F.col("date") < F.lit(_LATE), F.col("date") >= F.lit(_LATE)):
        write_new_dates(bars(spark, sf_dir).where(part), stored, STOCK_BARS)
        run_backfill(spark, stored, path)
    return rounded(read_table(spark, path, INDICATORS), INDICATOR_COLUMNS, DIGITS)


# Bars that arrive after all others: of two brands the 13th of the last months, of one a whole month.
LATE_BARS = (
    "date >= DATE '2001-06-01' AND (symbol IN ('Brand#11', 'Brand#35') AND day(date) = 13"
    " OR symbol = 'Brand#22' AND month(date) = 9)"
)


@query("refresh_indicators", ALL_SQL)
def refresh_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job that goes on from stored states: early bars, later bars, then bars that are late."""
    stored, path, state = (new_folder(spark, name) for name in ("bars", "indicators", "state"))
    early = F.col("date") < F.lit(_LATE)
    for part in (early & ~F.expr(LATE_BARS), ~early & ~F.expr(LATE_BARS), F.expr(LATE_BARS)):
        write_upsert(align_to_schema(bars(spark, sf_dir).where(part), STOCK_BARS), stored, STOCK_BARS)
        run_refresh(spark, stored, path, state)
    return rounded(read_table(spark, path, INDICATORS), INDICATOR_COLUMNS, DIGITS)


@query("daily_from_state", f"{ALL_SQL} where date between date '{_CUT}' - 1 and date '{_CUT}'")
def daily_from_state_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job on two days: the first run builds the states, the second goes on from them."""
    stored, path, state = (new_folder(spark, name) for name in ("bars", "indicators", "state"))
    write_new_dates(bars(spark, sf_dir), stored, STOCK_BARS)
    for day in (_CUT - timedelta(1), _CUT):
        run_daily(spark, stored, path, day, state)
    return rounded(read_table(spark, path, INDICATORS), INDICATOR_COLUMNS, DIGITS)


@query("daily_indicators", f"{ALL_SQL} where date = date '{_CUT}'")
def daily_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a date that a filled table lacks; run again with them in it, there are none."""
    bar_table = bars(spark, sf_dir)
    done = written(compute_all_indicators(load_series(bar_table.where(F.col("date") < F.lit(_CUT)))), "indicators")
    fresh = written(daily_indicators(bar_table, done, _CUT), "daily")
    again = daily_indicators(bar_table, done.unionByName(fresh), _CUT)
    return rounded(fresh.unionByName(again), INDICATOR_COLUMNS, DIGITS)


@query("run_daily", f"{ALL_SQL} where date = date '{_CUT}'")
def run_daily_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job on stored tables, run twice; the second run finds the date done."""
    stored, path = new_folder(spark, "bars"), new_folder(spark, "indicators")
    write_new_dates(bars(spark, sf_dir), stored, STOCK_BARS)
    for _ in range(2):
        run_daily(spark, stored, path, _CUT)
    return rounded(read_table(spark, path, INDICATORS), INDICATOR_COLUMNS, DIGITS)
