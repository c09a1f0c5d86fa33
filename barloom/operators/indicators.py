"""Technical indicators as column plans over one partitioning.

An ``Indicator`` lists its columns by stage. ``compute`` merges the stages of any number of
indicators, so columns that several of them need (true range, the 14-row high and low, the
exponential means of MACD) are built once and all of them share one shuffle and one sort:

    base -> runs -> near -> derived -> far + scans -> derived2 -> far2 + scans2 -> final

``near``, ``far`` and ``far2`` hold window columns, one Window node each; the other stages
are plain projections, with ``middle`` between ``far`` and the sums of ``scans``. A column
should be defined in the first stage that has its inputs: what later stages do not use is
then pruned from the rows that the later Window nodes copy.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.series import (
    TYPICAL_PRICE,
    SeriesWindow,
    full,
    ratio,
    true_range,
)
from barloom.operators.blocks import BLOCK, BLOCK_ROWS, HALO, Blocked, split_series
from barloom.operators.recurrence import (
    ANYWHERE,
    LEADING,
    NEVER,
    BlockScan,
    Ewm,
    Scan,
    Total,
    block_rows_for,
    span_alpha,
    wilder_alpha,
)
from barloom.operators.stages import Stages

Plain = Mapping[str, str]
Windowed = Callable[[SeriesWindow], Mapping[str, str]]

# Spark evaluates a sliding frame afresh on every row, while lags by the same distance share
# one pass. So frames are sums, extremes and so on over lagged columns; longer extremes join
# several frames of SHORT_FRAME rows and longer means are differences of running sums. So that a
# plan does not grow with its periods, extremes of more than LONG_FRAME rows are those of two
# runs of rows, and what needs every value of a long frame is folded over an array of them.
SHORT_FRAME = 13
SUMMED_FRAME = 40
LONG_FRAME = 64


def _none(_: SeriesWindow) -> Mapping[str, str]:
    return {}


@dataclass(frozen=True)
class Indicator:
    """Output columns and the staged columns they are made of.

    ``history`` is the number of earlier rows the window columns look back over; scans look
    back to the start of the series and need none.
    """

    outputs: tuple[str, ...]
    history: int = 0
    base: Plain = field(default_factory=dict)
    #: Lengths for which the running extremes of runs of so many rows are needed; see ``_run_extremes``.
    runs: tuple[int, ...] = ()
    near: Windowed = _none
    derived: Plain = field(default_factory=dict)
    derived_more: Plain = field(default_factory=dict)
    far: Windowed = _none
    middle: Plain = field(default_factory=dict)
    scans: tuple[Scan, ...] = ()
    derived2: Plain = field(default_factory=dict)
    far2: Windowed = _none
    scans2: tuple[Scan, ...] = ()
    final: Plain = field(default_factory=dict)


def _merged(parts: Sequence[Mapping[str, str]]) -> dict[str, str]:
    """All columns of the parts; one name with two definitions would give a wrong result."""
    out: dict[str, str] = {}
    for part in parts:
        for name, sql in part.items():
            if out.setdefault(name, sql) != sql:
                raise ValueError(f"two indicators define {name!r} differently; use renamed() on one of them")
    return out


def renamed(indicator: Indicator, suffix: str) -> Indicator:
    """The indicator with ``suffix`` on its output names, and on helpers that go by no parameter.

    So two instances whose columns would have the same names can be computed together.
    """
    own = [*indicator.outputs, *[n for n in _BARE_HELPERS if _mentions(indicator, n)]]
    names = re.compile(rf"(?<![\w])({'|'.join(map(re.escape, sorted(own, key=len, reverse=True)))})(?![\w])")
    # A lag of a renamed column carries the column's name in its own.
    lags = re.compile(rf"(_lag\d+_)({'|'.join(map(re.escape, sorted(own, key=len, reverse=True)))})(?![\w])")

    def text(sql: str) -> str:
        return names.sub(rf"\1{suffix}", lags.sub(rf"\1\2{suffix}", sql))

    def plain(part: Plain) -> Plain:
        return {text(name): text(sql) for name, sql in part.items()}

    def scan(s: Scan) -> Scan:
        return replace(s, out=text(s.out), x=text(s.x))

    changes = {}
    for f in fields(indicator):
        value = getattr(indicator, f.name)
        if f.name in ("near", "far", "far2"):
            changes[f.name] = lambda w, part=value: plain(part(w))
        elif f.name in ("scans", "scans2"):
            changes[f.name] = tuple(map(scan, value))
        elif f.name == "outputs":
            changes[f.name] = tuple(map(text, value))
        elif f.name not in ("history", "runs"):
            changes[f.name] = plain(value)
    return replace(indicator, **changes)


#: Helper columns whose names carry no parameter although their definitions depend on one.
_BARE_HELPERS = ("_dx",)


def _mentions(indicator: Indicator, name: str) -> bool:
    return name in indicator.derived2


# -- shared columns -------------------------------------------------------------------


def _both(*parts: Windowed) -> Windowed:
    return lambda w: {name: sql for part in parts for name, sql in part(w).items()}


def _lagged(column: str, n: int = 1) -> Windowed:
    return lambda w: {f"_lag{n}_{column}": w.lag(f"`{column}`", n)}


_PREV_CLOSE = _lagged("close")
_TR = {"_tr": true_range("_lag1_close")}
_TR_GAPS = {"made_of": ("high", "low"), "otherwise": NEVER}
_TP = {"_tp": TYPICAL_PRICE}
_TP_MOVE = {"_tp_move": "_tp - _lag1__tp"}


def _lags(column: str, n: int) -> Windowed:
    """The earlier values of a frame of n rows."""
    return _both(*[_lagged(column, k) for k in range(1, n)])


def _values(column: str, n: int) -> list[str]:
    """The values of a frame of n rows, newest first; those before the series are null."""
    return [f"`{column}`", *[f"_lag{k}_{column}" for k in range(1, n)]]


def _sum(terms: Sequence[str]) -> str:
    """Null if any term is null, so a short or incomplete frame has no sum."""
    return f"({' + '.join(terms)})"


def _of(function: str, args: Sequence[str]) -> str:
    return f"{function}({', '.join(args)})" if len(args) > 1 else args[0]


def _frame(column: str, n: int) -> Windowed:
    """An array of the values of a frame of n rows, nulls left out."""
    frame = f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"
    return lambda w: {f"_frame{n}_{column}": f"collect_list(`{column}`) {w.over(frame)}"}


def _fold(column: str, n: int, term: str) -> str:
    """Sum of ``term``, in which v is a value, over the frame."""
    return f"aggregate(_frame{n}_{column}, 0D, (a, v) -> a + {term})"


def _run_extremes(n: int, w: SeriesWindow) -> list[dict[str, str]]:
    """Stages of the extremes from the begin of a row's run up to it, and from it to the run's end.

    Rows are cut into runs of n. The last n rows of any row are the end of one run and the begin of
    the next, or one run, so two values give their extreme, whatever n is.
    """
    run = replace(w, keys=(*w.keys, f"_run_{n}"))
    back = f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in run.keys)} ORDER BY `{w.order}` DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return [
        {"_seq": f"row_number() {w.over()}"},
        {f"_run_{n}": f"(_seq - 1) DIV {n}"},
        {f"_high_to_{n}": f"max(high) {run.running}", f"_low_to_{n}": f"min(low) {run.running}"},
        {f"_high_from_{n}": f"max(high) {back}", f"_low_from_{n}": f"min(low) {back}"},
    ]


class _HighLow:
    """Highest high and lowest low of n rows."""

    def __init__(self, n: int):
        self.n, self.short, self.long = n, min(n, SHORT_FRAME), n > LONG_FRAME
        self.hh, self.ll = (full(f"_{c}_{n}", c, n) for c in ("high", "low"))

    @property
    def runs(self) -> tuple[int, ...]:
        return (self.n,) if self.long else ()

    def near(self, w: SeriesWindow) -> dict[str, str]:
        if self.long:
            return {**w.marks("high", self.n), **w.marks("low", self.n)}
        return {
            **_lags("high", self.short)(w),
            **_lags("low", self.short)(w),
            **w.marks("high", self.n),
            **w.marks("low", self.n),
        }

    @property
    def derived(self) -> dict[str, str]:
        if self.long:
            return {}
        return {
            f"_high_{self.short}": _of("greatest", _values("high", self.short)),
            f"_low_{self.short}": _of("least", _values("low", self.short)),
        }

    def _joined(self, function: str, w: SeriesWindow, column: str) -> str:
        backs = [*range(self.short, self.n - self.short, self.short), self.n - self.short]
        return _of(function, [column, *[w.lag(column, b) for b in backs]])

    def far(self, w: SeriesWindow) -> dict[str, str]:
        n = self.n
        if self.long:
            return {
                f"_high_{n}": f"greatest(_high_to_{n}, {w.lag(f'_high_from_{n}', n - 1)})",
                f"_low_{n}": f"least(_low_to_{n}, {w.lag(f'_low_from_{n}', n - 1)})",
            }
        if self.n == self.short:
            return {}
        return {
            f"_high_{self.n}": self._joined("greatest", w, f"_high_{self.short}"),
            f"_low_{self.n}": self._joined("least", w, f"_low_{self.short}"),
        }


def _bounded_index(up: str, down: str) -> str:
    """100 - 100 / (1 + up/down), null when ``down`` is zero."""
    return f"100 - 100 / (1 + {ratio(up, down)})"


# -- momentum -------------------------------------------------------------------------


def rsi(period: int = 14, column: str = "close") -> Indicator:
    """Relative strength from Wilder means of gains and losses; null while losses are zero."""
    out, move = f"rsi_{period}", f"(`{column}` - _lag1_{column})"
    gain, loss = f"_gain_{column}", f"_loss_{column}"
    # Any column may have gaps: a close that is text or not a number is null after the cast. Where
    # there are none, only the first row has no move.
    a, gaps = wilder_alpha(period), {"made_of": (column,), "otherwise": LEADING}
    up = Ewm(f"_mean{period}{gain}", gain, a, period, **gaps)
    down = Ewm(f"_mean{period}{loss}", loss, a, period, **gaps)
    return Indicator(
        (out,),
        history=1,
        near=_lagged(column),
        derived={
            gain: f"CASE WHEN {move} > 0 THEN {move} WHEN {move} <= 0 THEN 0D END",
            loss: f"CASE WHEN {move} < 0 THEN -{move} WHEN {move} >= 0 THEN 0D END",
        },
        scans=(up, down),
        final={out: _bounded_index(up.out, down.out)},
    )


def _ema_scan(period: int, column: str) -> Ewm:
    out = f"ema_{period}" if column == "close" else f"ema_{period}_{column}"
    return Ewm(out, column, span_alpha(period), made_of=(column,), otherwise=NEVER)


def macd(fast: int = 12, slow: int = 26, signal: int = 9, column: str = "close") -> Indicator:
    """Difference of two exponential means, its own exponential mean, and their difference."""
    quick, slower = _ema_scan(fast, column), _ema_scan(slow, column)
    return Indicator(
        ("macd_line", "macd_signal", "macd_hist"),
        scans=(quick, slower),
        derived2={"macd_line": f"{quick.out} - {slower.out}"},
        scans2=(Ewm("macd_signal", "macd_line", span_alpha(signal), made_of=(column,), otherwise=NEVER),),
        final={"macd_hist": "macd_line - macd_signal"},
    )


def stochastic(k_period: int = 14, d_period: int = 3) -> Indicator:
    r = _HighLow(k_period)
    return Indicator(
        ("stoch_k", "stoch_d"),
        history=k_period + d_period,
        runs=r.runs,
        near=r.near,
        derived=r.derived,
        far=r.far,
        middle={"stoch_k": f"{ratio(f'close - {r.ll}', f'{r.hh} - {r.ll}')} * 100"},
        far2=_lags("stoch_k", d_period),
        final={"stoch_d": f"{_sum(_values('stoch_k', d_period))} / {d_period}"},
    )


def cci(period: int = 20) -> Indicator:
    """Distance of the typical price from its mean, in units of 0.015 mean deviations."""
    out, n, tps = f"cci_{period}", period, _values("_tp", period)
    mean, moved = f"_mean{n}__tp", f"_moved{n}__tp"
    if n > SUMMED_FRAME:
        frame, dev = f"_frame{n}__tp", f"{_fold('_tp', n, f'abs(v - {mean})')} / {n}"
        return Indicator(
            (out,),
            history=n,
            base=_TP,
            near=_both(_frame("_tp", n), lambda w: w.marks("_tp", n)),
            derived={
                mean: full(f"{_fold('_tp', n, 'v')} / {n}", "_tp", n),
                moved: f"array_max({frame}) > array_min({frame})",
            },
            derived_more={out: f"CASE WHEN {moved} THEN (_tp - {mean}) / nullif(0.015D * {dev}, 0D) END"},
        )
    dev = f"{_sum([f'abs({v} - {mean})' for v in tps])} / {n}"
    return Indicator(
        (out,),
        history=n,
        base=_TP,
        near=_lags("_tp", n),
        # A constant window has no deviation, whatever the rounding of its mean.
        derived={
            mean: f"{_sum(tps)} / {n}",
            moved: f"{_of('greatest', tps)} > {_of('least', tps)}",
        },
        derived_more={out: f"CASE WHEN {moved} THEN (_tp - {mean}) / nullif(0.015D * {dev}, 0D) END"},
    )


def williams_r(period: int = 14) -> Indicator:
    r = _HighLow(period)
    return Indicator(
        ("williams_r",),
        history=period,
        runs=r.runs,
        near=r.near,
        derived=r.derived,
        far=r.far,
        middle={"williams_r": f"{ratio(f'{r.hh} - close', f'{r.hh} - {r.ll}')} * -100"},
    )


def momentum(period: int = 5, column: str = "close") -> Indicator:
    out = f"momentum_{period}"
    return Indicator(
        (out,),
        history=period,
        near=_lagged(column, period),
        derived={out: f"{ratio(f'`{column}`', f'_lag{period}_{column}')} - 1"},
    )


# -- trend ----------------------------------------------------------------------------


def sma(period: int = 5, column: str = "close") -> Indicator:
    out, n, total = f"sma_{period}", period, f"_sum_{column}"
    if n <= SUMMED_FRAME:
        mean = f"{_sum(_values(column, n))} / {n}"
        return Indicator((out,), history=n, near=_lags(column, n), derived={out: mean})
    mean = full(f"({total} - coalesce(_lag{n}_{total}, 0D)) / {n}", column, n)
    return Indicator(
        (out,),
        history=n,
        near=lambda w: {
            **w.marks(column, n),
            total: f"sum(`{column}`) {w.running}",
        },
        far=_lagged(total, n),
        middle={out: mean},
    )


def ema(period: int = 12, column: str = "close") -> Indicator:
    scan = _ema_scan(period, column)
    return Indicator((scan.out,), scans=(scan,))


def adx(window: int = 14) -> Indicator:
    """Directional movement: +DI, -DI and the Wilder mean of their relative distance."""
    a, n = wilder_alpha(window), window
    up, down = "(high - _lag1_high)", "(_lag1_low - low)"
    tr = Ewm(f"_mean{n}_tr", "_tr", a, n, **_TR_GAPS)
    plus_dm = Ewm(f"_mean{n}_plus_dm", "_plus_dm", a, n, NEVER)
    minus_dm = Ewm(f"_mean{n}_minus_dm", "_minus_dm", a, n, NEVER)
    plus, minus = (f"100 * {ratio(dm.out, tr.out)}" for dm in (plus_dm, minus_dm))
    return Indicator(
        (f"adx_{n}", "plus_di", "minus_di"),
        history=1,
        near=_both(_PREV_CLOSE, _lagged("high"), _lagged("low")),
        derived={
            **_TR,
            "_plus_dm": f"CASE WHEN {up} > {down} AND {up} > 0 THEN {up} ELSE 0D END",
            "_minus_dm": f"CASE WHEN {down} > {up} AND {down} > 0 THEN {down} ELSE 0D END",
        },
        scans=(tr, plus_dm, minus_dm),
        derived2={
            "plus_di": plus,
            "minus_di": minus,
            "_dx": f"100 * {ratio(f'abs({plus} - {minus})', f'{plus} + {minus}')}",
        },
        scans2=(Ewm(f"adx_{n}", "_dx", a, n),),
    )


def slope(window: int = 20, column: str = "close") -> Indicator:
    """Least-squares slope of the last ``window`` values against their positions."""
    out, n = f"slope_{window}", window
    if n > SUMMED_FRAME:
        return _long_slope(out, n, column)
    newest, *earlier = _values(column, n)
    # Positions centred on the window; the newest value's own term is zero.
    terms = [f"{(n - 1) / 2 - k!r}D * ({v} - {newest})" for k, v in enumerate(earlier, 1)]
    square_sum = n * (n * n - 1) / 12
    return Indicator(
        (out,),
        history=n,
        near=_lags(column, n),
        derived={out: f"{_sum(terms)} / {square_sum!r}D"},
    )


def _long_slope(out: str, n: int, column: str) -> Indicator:
    """The slope from running sums of the values and of the values times their positions.

    Values are taken from the first one of the block, so that the sums stay small against the
    slope they are the difference of.
    """
    c, p = f"_off_{column}", f"_offpos_{column}"
    total, moment = f"_sum_{c}", f"_sum_{p}"
    window_sum = f"({total} - coalesce(_lag{n}_{total}, 0D))"
    window_moment = f"({moment} - coalesce(_lag{n}_{moment}, 0D))"
    middle = f"(_at - {(n - 1) / 2!r}D)"
    slope = f"({window_moment} - {middle} * {window_sum}) / {n * (n * n - 1) / 12!r}D"
    return Indicator(
        (out,),
        history=n,
        near=lambda w: {
            **w.marks(column, n),
            "_at": f"row_number() {w.over()}",
            f"_first_{column}": f"first(`{column}`, true) {w.running}",
        },
        derived={c: f"`{column}` - _first_{column}"},
        derived_more={p: f"{c} * _at"},
        far=lambda w: {total: f"sum({c}) {w.running}", moment: f"sum({p}) {w.running}"},
        far2=_both(_lagged(total, n), _lagged(moment, n)),
        final={out: full(slope, column, n)},
    )


def acceleration(window: int = 12, smooth: int = 3, column: str = "close") -> Indicator:
    """Change over ``smooth`` rows of the percent change over ``window`` rows."""
    roc = f"_roc{window}_{column}"
    return Indicator(
        ("acceleration",),
        history=window + smooth,
        near=_lagged(column, window),
        derived={roc: f"({ratio(f'`{column}`', f'_lag{window}_{column}')} - 1) * 100"},
        far=_lagged(roc, smooth),
        middle={"acceleration": f"{roc} - _lag{smooth}_{roc}"},
    )


# -- volatility -----------------------------------------------------------------------


def atr(period: int = 14) -> Indicator:
    scan = Ewm(f"_mean{period}_tr", "_tr", wilder_alpha(period), period, **_TR_GAPS)
    return Indicator(
        (f"atr_{period}",),
        history=1,
        near=_PREV_CLOSE,
        derived=_TR,
        scans=(scan,),
        final={f"atr_{period}": scan.out},
    )


def bollinger(period: int = 20, stddev: float = 2.0, column: str = "close") -> Indicator:
    """Mean plus and minus a multiple of the population standard deviation."""
    n, values = period, _values(column, period)
    mean = f"_mean{n}_{column}"
    if n > SUMMED_FRAME:
        spread = f"{float(stddev)!r}D * sqrt({_fold(column, n, f'pow(v - {mean}, 2)')} / {n})"
        return Indicator(
            ("bb_upper", "bb_lower"),
            history=n,
            near=_both(_frame(column, n), lambda w: w.marks(column, n)),
            derived={mean: full(f"{_fold(column, n, 'v')} / {n}", column, n)},
            derived_more={"bb_upper": f"{mean} + {spread}", "bb_lower": f"{mean} - {spread}"},
        )
    dev = f"sqrt({_sum([f'pow({v} - {mean}, 2)' for v in values])} / {n})"
    return Indicator(
        ("bb_upper", "bb_lower"),
        history=n,
        near=_lags(column, n),
        derived={mean: f"{_sum(values)} / {n}"},
        derived_more={
            "bb_upper": f"{mean} + {float(stddev)!r}D * {dev}",
            "bb_lower": f"{mean} - {float(stddev)!r}D * {dev}",
        },
    )


def ichimoku(conversion: int = 9, base: int = 26, span_b: int = 52) -> Indicator:
    """Mid-points of high and low; the two spans are shifted forward by ``base`` rows."""
    ranges = [_HighLow(n) for n in (conversion, base, span_b)]
    mid_c, mid_b, mid_s = (f"({r.hh} + {r.ll}) / 2" for r in ranges)
    return Indicator(
        ("ichimoku_conversion", "ichimoku_base", "ichimoku_span_a", "ichimoku_span_b"),
        history=max(base, span_b) + base,
        runs=tuple(n for r in ranges for n in r.runs),
        near=_both(*[r.near for r in ranges]),
        derived=_merged([r.derived for r in ranges]),
        far=_both(*[r.far for r in ranges]),
        middle={
            "ichimoku_conversion": mid_c,
            "ichimoku_base": mid_b,
            "_span_a": f"({mid_c} + {mid_b}) / 2",
            "_span_b": mid_s,
        },
        far2=lambda w: {
            "ichimoku_span_a": w.lag("_span_a", base),
            "ichimoku_span_b": w.lag("_span_b", base),
        },
    )


def chandelier_exit(period: int = 22, multiplier: float = 3.0) -> Indicator:
    r = _HighLow(period)
    if r.long:
        total = f"_sum__tr - coalesce(_lag{period}__sum__tr, 0D)"
        width = full(f"{float(multiplier)!r}D * ({total}) / {period}", "_tr", period)
        return Indicator(
            ("chandelier_long", "chandelier_short"),
            history=period + 1,
            runs=r.runs,
            near=_both(r.near, _PREV_CLOSE),
            derived=_TR,
            far=lambda w: {**r.far(w), **w.marks("_tr", period), "_sum__tr": f"sum(_tr) {w.running}"},
            far2=_lagged("_sum__tr", period),
            final={"chandelier_long": f"{r.hh} - {width}", "chandelier_short": f"{r.ll} + {width}"},
        )
    width = f"{float(multiplier)!r}D * {_sum(_values('_tr', period))} / {period}"
    return Indicator(
        ("chandelier_long", "chandelier_short"),
        history=period + 1,
        near=_both(r.near, _PREV_CLOSE),
        derived={**r.derived, **_TR},
        far=_both(r.far, _lags("_tr", period)),
        middle={"chandelier_long": f"{r.hh} - {width}", "chandelier_short": f"{r.ll} + {width}"},
    )


# -- volume ---------------------------------------------------------------------------


def obv() -> Indicator:
    """Running volume, signed by the direction of the close; null where volume is null."""
    return Indicator(
        ("obv",),
        history=1,
        near=_PREV_CLOSE,
        derived={"_obv_step": "vol * coalesce(signum(close - _lag1_close), 0D)"},
        scans=(Total("_obv_total", "_obv_step"),),
        final={"obv": "CASE WHEN vol IS NOT NULL THEN _obv_total END"},
    )


def mfi(period: int = 14) -> Indicator:
    """Money flow index; 50 where it is undefined."""
    n, move = period, _TP_MOVE["_tp_move"]
    flows = ("_flow_up", "_flow_down")
    if n > SUMMED_FRAME:
        # A flow is null only where the volume is and the price moved.
        up, down = (f"CASE WHEN size(_frame{n}_{c}) = {n} THEN {_fold(c, n, 'v')} END" for c in flows)
        far = _both(*[_frame(c, n) for c in flows])
    else:
        up, down = (_sum(_values(c, n)) for c in flows)
        far = _both(*[_lags(c, n) for c in flows])
    return Indicator(
        (f"mfi_{n}",),
        history=n + 1,
        base=_TP,
        near=_lagged("_tp"),
        derived={
            "_flow_up": f"CASE WHEN {move} > 0 THEN _tp * vol ELSE 0D END",
            "_flow_down": f"CASE WHEN {move} < 0 THEN _tp * vol ELSE 0D END",
        },
        far=far,
        middle={f"mfi_{n}": f"coalesce({_bounded_index(up, down)}, 50D)"},
    )


def kvo(fast: int = 34, slow: int = 55) -> Indicator:
    """Difference of two exponential means of volume signed and scaled by the price move."""
    move = f"({_TP_MOVE['_tp_move']})"
    gaps = {"made_of": ("high", "low", "close", "vol"), "otherwise": LEADING}
    quick = Ewm(f"_mean{fast}_vf", "_vf", span_alpha(fast), **gaps)
    slower = Ewm(f"_mean{slow}_vf", "_vf", span_alpha(slow), **gaps)
    return Indicator(
        ("kvo",),
        history=1,
        base=_TP,
        near=_lagged("_tp"),
        derived={"_vf": f"vol * CASE WHEN {move} > 0 THEN 1 ELSE -1 END * abs({move})"},
        scans=(quick, slower),
        final={"kvo": f"{quick.out} - {slower.out}"},
    )


def default_indicators() -> list[Indicator]:
    """The 35 stored measures with their default parameters."""
    return [
        rsi(),
        macd(),
        stochastic(),
        cci(),
        williams_r(),
        momentum(),
        *[sma(n) for n in (5, 10, 20, 50, 200)],
        *[ema(n) for n in (9, 12, 26, 200)],
        adx(),
        slope(),
        acceleration(),
        atr(),
        bollinger(),
        ichimoku(),
        chandelier_exit(),
        obv(),
        mfi(),
        kvo(),
    ]


# -- evaluation -----------------------------------------------------------------------


def look_back(indicators: Sequence[Indicator]) -> int:
    """Earlier rows of a series that window columns need besides the states of the scans."""
    return max([i.history for i in indicators], default=0)


def _block_rows(indicators: Sequence[Indicator], rows: int) -> int:
    return block_rows_for([s for i in indicators for s in (*i.scans, *i.scans2)], rows)


def compute(
    series: DataFrame,
    indicators: Sequence[Indicator],
    key: str = "symbol",
    order: str = "date",
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per row of ``series`` (unique on key and order): the keys and all outputs."""
    scans = [s for i in indicators for s in (*i.scans, *i.scans2)]
    inputs = {c for s in scans if isinstance(s, Ewm) for c in s.made_of}
    blocked = split_series(series, look_back(indicators), _block_rows(indicators, rows), key, order, inputs)
    return _evaluate(blocked, indicators)


def resume(
    series: DataFrame,
    entering: DataFrame,
    indicators: Sequence[Indicator],
    earlier: str,
    keep: str,
    key: str = "symbol",
    order: str = "date",
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``compute`` for series that go on behind stored rows.

    ``series`` holds, besides the new rows, the last ``look_back(indicators)`` rows before them (or all
    there are), marked by the boolean column ``earlier``; ``entering`` (key, scans) the states behind
    the last of these. Gives a row per new row: keys, outputs, and in ``scans`` the states behind
    the row where the column ``keep`` says so, else null. A series without a state starts anew.
    """
    blocked = split_series(series, look_back(indicators), _block_rows(indicators, rows), key, order)
    df = blocked.df
    if not blocked.split:
        df = df.selectExpr("*", f"0L AS {BLOCK}", f"false AS {HALO}")
    # An earlier row is no row of its block, wherever it stands.
    df = df.withColumn(HALO, F.col(HALO) | F.col(earlier))
    return _evaluate(Blocked(df, key, order, True), indicators, entering, keep).withColumnRenamed("_states", "scans")


def _evaluate(
    blocked: Blocked, indicators: Sequence[Indicator], entering: DataFrame | None = None, keep: str | None = None
) -> DataFrame:
    """Keys and outputs of the blocks' own rows; with ``keep`` also ``_states``."""

    def scans_of(part: str) -> list[Scan]:
        scans = [s for i in indicators for s in getattr(i, part)]
        return [s.given(blocked.full) if isinstance(s, Ewm) else s for s in scans]

    scans, scans2 = scans_of("scans"), scans_of("scans2")
    _merged([{s.out: repr(s)} for s in scans + scans2])
    w = blocked.window
    one, two = (BlockScan(blocked, of, level, entering) for of, level in ((scans, "s1"), (scans2, "s2")))

    def plain(part: str) -> dict[str, str]:
        return _merged([getattr(i, part) for i in indicators])

    def windows(part: str) -> dict[str, str]:
        return _merged([getattr(i, part)(w) for i in indicators])

    stages = Stages(blocked.df)
    stages.add(plain("base"))
    for n in sorted({n for i in indicators for n in i.runs}):
        for columns in _run_extremes(n, w):
            stages.add(columns)
    stages.add(windows("near") | one.start() | two.start())
    stages.add(plain("derived"))
    stages.add(plain("derived_more"))
    stages.add(windows("far") | one.positions())
    stages.add(plain("middle"))
    stages.add(one.gaps())
    stages.add(one.scale())
    stages.add(one.sums())
    stages = one.finish(stages)
    stages.add(plain("derived2"))
    stages.add(windows("far2") | two.positions())
    stages.add(two.gaps())
    stages.add(two.scale())
    stages.add(two.sums())
    stages = two.finish(stages)
    stages.add(plain("final"))
    outputs = list(dict.fromkeys(o for i in indicators for o in i.outputs))
    if keep:
        states = ", ".join(one.states() + two.states())
        stages.add({"_states": f"CASE WHEN `{keep}` THEN array({states}) END"})
        outputs.append("_states")
    df = stages.df
    if blocked.split:
        df = df.where(f"NOT {HALO}")
    return df.select(blocked.order, blocked.key, *outputs)
