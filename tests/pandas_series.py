"""The 35 measures of one series with pandas and numpy: the yardstick of tests and benchmark."""

from __future__ import annotations

import numpy as np
import pandas as pd

from barloom.schema import INDICATOR_COLUMNS


def smooth(x: pd.Series, alpha: float, need: int = 0) -> pd.Series:
    return x.ewm(alpha=alpha, adjust=False, min_periods=need).mean()


def frames(x: pd.Series, n: int) -> np.ndarray:
    """One row of n values per position; positions without a full frame are NaN."""
    out = np.full((len(x), n), np.nan)
    if len(x) >= n:
        out[n - 1 :] = np.lib.stride_tricks.sliding_window_view(x.to_numpy(float), n)
    return out


def _spread(frame: np.ndarray) -> float:
    """Mean distance from the mean: twice the excess over it, shared out."""
    return 2 * np.maximum(frame - np.mean(frame), 0).sum() / frame.size


def measures(bars: pd.DataFrame, callbacks: bool = False) -> pd.DataFrame:
    """``bars``: the rows of one symbol in date order.

    With ``callbacks`` the mean deviation and the slope call a function per frame, the plain
    way to write them in pandas; otherwise they are array operations over all frames.
    """
    bars = bars.reset_index(drop=True)
    o = bars[["date", "symbol"]].copy()
    c, h, lo, v = (bars[k].astype(float) for k in ("close", "high", "low", "vol"))
    before = c.shift()
    move = c - before
    # The day's range, stretched to yesterday's close where there is one.
    whole = h.notna() & lo.notna()
    reach = (np.fmax(h, before) - np.fmin(lo, before)).where(whole, (h.fillna(lo) - before).abs())
    typical = (h + lo + c) / 3
    shift = typical - typical.shift()

    up, down = smooth(move.where(move > 0, 0).where(move.notna()), 1 / 14, 14), smooth(
        (-move).where(move < 0, 0).where(move.notna()), 1 / 14, 14
    )
    o["rsi_14"] = 100 - 100 / (1 + up / down.replace(0, np.nan))
    for n in (9, 12, 26, 200):
        o[f"ema_{n}"] = smooth(c, 2 / (n + 1))
    o["macd_line"] = o["ema_12"] - o["ema_26"]
    o["macd_signal"] = smooth(o["macd_line"], 0.2)
    o["macd_hist"] = o["macd_line"] - o["macd_signal"]
    top = {n: h.rolling(n).max() for n in (9, 14, 22, 26, 52)}
    low = {n: lo.rolling(n).min() for n in (9, 14, 22, 26, 52)}
    width = (top[14] - low[14]).replace(0, np.nan)
    o["stoch_k"], o["williams_r"] = 100 * (c - low[14]) / width, -100 * (top[14] - c) / width
    o["stoch_d"] = pd.Series(frames(o["stoch_k"], 3).mean(axis=1))
    f = frames(typical, 20)
    off = np.abs(f - f.mean(axis=1, keepdims=True)).mean(axis=1)
    if callbacks:
        off = typical.rolling(20).apply(_spread, raw=True).to_numpy(copy=True)
    off[f.max(axis=1) == f.min(axis=1)] = np.nan
    o["cci_20"] = (typical - f.mean(axis=1)) / (0.015 * off)
    o["momentum_5"] = c / c.shift(5) - 1
    for n in (5, 10, 20, 50, 200):
        o[f"sma_{n}"] = c.rolling(n).mean()
    x = np.arange(20) - 9.5
    f = frames(c, 20)
    o["slope_20"] = (f - f[:, :1]) @ x / (x @ x)
    if callbacks:
        o["slope_20"] = c.rolling(20).apply(lambda y: np.polyfit(x, y, 1)[0], raw=True)
    o["bb_upper"] = f.mean(axis=1) + 2 * f.std(axis=1)
    o["bb_lower"] = f.mean(axis=1) - 2 * f.std(axis=1)
    rate = 100 * (c / c.shift(12) - 1)
    o["acceleration"] = rate - rate.shift(3)

    rise, fall = h - h.shift(), lo.shift() - lo
    o["atr_14"] = smooth(reach, 1 / 14, 14)
    for name, a, b in (("plus_di", rise, fall), ("minus_di", fall, rise)):
        o[name] = 100 * smooth(a.where((a > b) & (a > 0), 0.0), 1 / 14, 14) / o["atr_14"]
    spread = (o["plus_di"] + o["minus_di"]).replace(0, np.nan)
    o["adx_14"] = smooth(100 * (o["plus_di"] - o["minus_di"]).abs() / spread, 1 / 14, 14)

    o["ichimoku_conversion"], o["ichimoku_base"] = (top[9] + low[9]) / 2, (top[26] + low[26]) / 2
    o["ichimoku_span_a"] = ((o["ichimoku_conversion"] + o["ichimoku_base"]) / 2).shift(26)
    o["ichimoku_span_b"] = ((top[52] + low[52]) / 2).shift(26)
    mean_reach = frames(reach, 22).mean(axis=1)
    o["chandelier_long"], o["chandelier_short"] = top[22] - 3 * mean_reach, low[22] + 3 * mean_reach

    o["obv"] = pd.Series(np.select([move > 0, move < 0], [v, -v], 0.0)).where(v.notna()).cumsum()
    flow = typical * v
    gain, loss = (frames(flow.where(m, 0.0), 14).sum(axis=1) for m in (shift > 0, shift < 0))
    loss[loss == 0] = np.nan
    o["mfi_14"] = pd.Series(100 - 100 / (1 + gain / loss)).fillna(50)
    # The size of a move carries its sign already; a first row has no move and no force.
    force = v * shift
    o["kvo"] = smooth(force, 2 / 35) - smooth(force, 2 / 56)
    return o[["date", "symbol", *INDICATOR_COLUMNS]]
