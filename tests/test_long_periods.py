"""Indicators of long periods against pandas, and plans that don't grow with the period."""

import numpy as np
import pandas as pd
import pytest

from barloom.operators import indicators as I
from test_indicators import SCHEMA, check, table, walk

LONG = [
    I.cci(200), I.slope(500), I.slope(41, "high"), I.stochastic(130, 3), I.bollinger(150), I.mfi(60),
    I.ichimoku(65, 130, 260), I.chandelier_exit(100), I.sma(300),
]


def frames(x, n):
    out = np.full((len(x), n), np.nan)
    if len(x) >= n:
        out[n - 1 :] = np.lib.stride_tricks.sliding_window_view(x.to_numpy(float), n)
    return out


def slope(x, n):
    k = np.arange(n) - (n - 1) / 2
    return (frames(x, n) * k).sum(axis=1) / (k * k).sum()


def expected(rows):
    b = pd.DataFrame(rows, columns=[f.split()[0] for f in SCHEMA.split(", ")])
    o = b[["date", "symbol"]].copy()
    c, h, lo, v = (b[k].astype(float) for k in ("close", "high", "low", "vol"))
    tp = (h + lo + c) / 3
    f = frames(tp, 200)
    o["cci_200"] = (tp - f.mean(axis=1)) / (0.015 * np.abs(f - f.mean(axis=1, keepdims=True)).mean(axis=1))
    o["slope_500"], o["slope_41"] = slope(c, 500), slope(h, 41)
    top = {n: h.rolling(n).max() for n in (65, 100, 130, 260)}
    low = {n: lo.rolling(n).min() for n in (65, 100, 130, 260)}
    o["stoch_k"] = 100 * (c - low[130]) / (top[130] - low[130])
    o["stoch_d"] = o["stoch_k"].rolling(3).mean()
    mean, dev = c.rolling(150).mean(), c.rolling(150).std(ddof=0)
    o["bb_upper"], o["bb_lower"] = mean + 2 * dev, mean - 2 * dev
    move, flow = tp - tp.shift(), tp * v
    # Without a volume there is no flow; where the price is unknown nothing flows.
    up = pd.Series(np.where(move > 0, flow, 0.0)).rolling(60).sum()
    down = pd.Series(np.where(move < 0, flow, 0.0)).rolling(60).sum()
    o["mfi_60"] = (100 - 100 / (1 + up / down.replace(0, np.nan))).fillna(50)
    mid = {n: (top[n] + low[n]) / 2 for n in (65, 130, 260)}
    o["ichimoku_conversion"], o["ichimoku_base"] = mid[65], mid[130]
    o["ichimoku_span_a"], o["ichimoku_span_b"] = ((mid[65] + mid[130]) / 2).shift(130), mid[260].shift(130)
    before = c.shift()
    tr = pd.concat([h - lo, (h - before).abs(), (lo - before).abs()], axis=1).max(axis=1)
    width = 3 * tr.rolling(100).mean()
    o["chandelier_long"], o["chandelier_short"] = top[100] - width, low[100] + width
    o["sma_300"] = c.rolling(300).mean()
    return o


@pytest.mark.parametrize("rows_per_block", [4096, 900])
@pytest.mark.parametrize("gaps", [0.0, 0.002])
def test_long_periods(spark, rows_per_block, gaps):
    parts = [walk("LONG", 2200, 1, gaps), walk("SHORT", 270, 2, gaps), walk("SPARSE", 700, 3, gaps, 5), walk("ONE", 1, 4)]
    got = I.compute(table(spark, [r for p in parts for r in p]), LONG, rows=rows_per_block).toPandas()
    want = pd.concat([expected(p) for p in parts])
    check(got, want, [c for i in LONG for c in i.outputs])


def test_a_constant_series_has_no_deviation(spark):
    rows = [(r[0], "FLAT", *[7.1] * 5, 10.0) for r in walk("A", 300, 1)]
    got = I.compute(table(spark, rows), [I.cci(100), I.slope(100), I.stochastic(100), I.bollinger(100)]).toPandas()
    last = got.sort_values("date").iloc[-1]
    assert pd.isna(last["cci_100"]) and last["slope_100"] == 0 and pd.isna(last["stoch_k"]) and last["bb_upper"] == pytest.approx(7.1)


def nodes(df):
    return len(df._jdf.queryExecution().analyzed().toString())


@pytest.mark.parametrize("make", [I.cci, I.slope, I.stochastic, I.williams_r, I.bollinger, I.mfi, I.chandelier_exit])
def test_plans_do_not_grow_with_the_period(spark, make):
    series = table(spark, walk("A", 30, 1))
    assert nodes(I.compute(series, [make(2000)], rows=4096)) < 1.1 * nodes(I.compute(series, [make(100)], rows=4096))


def test_two_long_instances(spark):
    rows = table(spark, walk("A", 400, 5))
    both = I.compute(rows, [I.stochastic(100), I.renamed(I.stochastic(90), "_b")]).orderBy("date").toPandas()
    alone = I.compute(rows, [I.stochastic(90)]).orderBy("date").toPandas()
    np.testing.assert_allclose(both["stoch_k_b"].astype(float), alone["stoch_k"].astype(float))
