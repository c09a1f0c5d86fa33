"""Indicators and the weighted mean against pandas, in one block and in many."""

import datetime
from pyspark.sql import functions as F
import math
import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest

from barloom.operators import indicators as I
from barloom.operators.blocks import split_series
from barloom.operators.recurrence import ANYWHERE, Ewm, Total, block_rows_for, ewm
from barloom.plans.incremental import compute_all_indicators
from barloom.schema import INDICATOR_COLUMNS
from barloom.sources.bars import load_series
from pandas_series import measures

SCHEMA = "date date, symbol string, open double, high double, low double, close double, ltp double, vol double"
START = date(2015, 1, 1)


def walk(symbol, n, seed, gaps=0.0, step=1):
    rng, price, rows = random.Random(seed), 100.0, []
    for i in range(n):
        price = max(1.0, price + rng.uniform(-2, 2))
        high, low = price + rng.uniform(0, 3), price - rng.uniform(0, 0.9)
        row = [price, high, low, price, price, float(rng.randint(1, 900))]
        for k in (1, 2, 5):
            if rng.random() < gaps:
                row[k] = None
        rows.append((START + timedelta(days=step * i), symbol, *row))
    return rows


def table(spark, rows):
    return load_series(spark.createDataFrame(rows, SCHEMA))


def check(got, want, columns):
    got = got.sort_values(["symbol", "date"], ignore_index=True)
    want = want.sort_values(["symbol", "date"], ignore_index=True)
    assert len(got) == len(want)
    for c in columns:
        g, w = got[c].to_numpy(float), want[c].replace([np.inf, -np.inf], np.nan).to_numpy(float)
        assert (np.isnan(g) == np.isnan(w)).all(), c
        np.testing.assert_allclose(g, w, rtol=1e-7, atol=1e-7, err_msg=c)


def expected(rows):
    frame = pd.DataFrame(rows, columns=[f.split()[0] for f in SCHEMA.split(", ")])
    return pd.concat([measures(g) for _, g in frame.groupby("symbol")])


@pytest.mark.parametrize("rows_per_block", [4096, 400])
@pytest.mark.parametrize("gaps", [0.0, 0.05])
def test_all_indicators(spark, rows_per_block, gaps):
    """Interleaved series of several lengths, one of them traded once in ten days."""
    rows = walk("LONG", 1500, 1, gaps) + walk("MID", 260, 2, gaps) + walk("SPARSE", 700, 3, gaps, 10)
    rows += walk("ONE", 1, 4) + walk("FIVE", 5, 5) + walk("THIRTEEN", 13, 6)
    random.Random(0).shuffle(rows)
    got = compute_all_indicators(table(spark, rows), rows_per_block).toPandas()
    check(got, expected(sorted(rows, key=lambda r: (r[1], r[0]))), INDICATOR_COLUMNS)


def test_blocks_are_bounded(spark):
    rows = walk("LONG", 1500, 1) + walk("SHORT", 50, 2)
    blocked = split_series(table(spark, rows), halo=100, rows=300)
    sizes = blocked.df.groupBy("symbol", "_blk", "_halo").count().collect()
    assert blocked.split
    own = [r["count"] for r in sizes if not r["_halo"]]
    assert sum(own) == 1550 and max(own) < 300 + 64 and len(own) > 4
    assert all(100 <= r["count"] < 100 + 64 for r in sizes if r["_halo"])


def test_ramp_and_flat(spark):
    up = [(START + timedelta(days=i), "UP", *[100.0 + i] * 5, 10.0) for i in range(40)]
    flat = [(START + timedelta(days=i), "FLAT", *[7.1] * 5, 10.0) for i in range(40)]
    out = {(r["symbol"], r["date"]): r for r in compute_all_indicators(table(spark, up + flat)).collect()}
    last = START + timedelta(days=39)
    ramp, level = out["UP", last], out["FLAT", last]
    # No loss and no negative flow: undefined strength, neutral money flow.
    assert ramp["rsi_14"] is None and ramp["mfi_14"] == 50
    assert ramp["slope_20"] == pytest.approx(1) and ramp["obv"] == 390
    assert ramp["sma_5"] == 137 and ramp["stoch_k"] == 100 and ramp["williams_r"] == 0
    for c in ("rsi_14", "stoch_k", "stoch_d", "cci_20", "williams_r", "adx_14"):
        assert level[c] is None, c
    assert level["bb_upper"] == pytest.approx(7.1) and level["obv"] == 0 and level["slope_20"] == 0


def test_warm_up_rows(spark):
    """First row with a value, counted from 0."""
    first = {
        "rsi_14": 14, "macd_line": 0, "macd_signal": 0, "stoch_k": 13, "stoch_d": 15, "cci_20": 19,
        "williams_r": 13, "momentum_5": 5, "sma_5": 4, "sma_200": 199, "ema_9": 0, "plus_di": 13,
        "adx_14": 26, "slope_20": 19, "acceleration": 15, "atr_14": 13, "bb_upper": 19,
        "ichimoku_conversion": 8, "ichimoku_base": 25, "ichimoku_span_a": 51, "ichimoku_span_b": 77,
        "chandelier_long": 21, "obv": 0, "mfi_14": 0, "kvo": 1,
    }
    got = compute_all_indicators(table(spark, walk("A", 260, 9))).toPandas().sort_values("date")
    for c, n in first.items():
        assert got[c].reset_index(drop=True).first_valid_index() == n, c


def test_parameters(spark):
    """Other parameters than the defaults, over another column."""
    rows = walk("A", 300, 7, gaps=0.1)
    got = I.compute(
        table(spark, rows), [I.sma(7, "high"), I.sma(60, "high"), I.ema(3, "vol"), I.rsi(5, "high")], rows=200
    ).toPandas().sort_values("date", ignore_index=True)
    frame = pd.DataFrame(rows, columns=[f.split()[0] for f in SCHEMA.split(", ")])
    want = pd.DataFrame({"date": frame["date"], "symbol": "A"})
    want["sma_7"] = frame["high"].rolling(7).mean()
    want["sma_60"] = frame["high"].rolling(60).mean()
    want["ema_3_vol"] = frame["vol"].ewm(span=3, adjust=False).mean()
    check(got, want, ["sma_7", "sma_60", "ema_3_vol"])


def by_hand(values, alpha, need):
    out, y, gap, seen = [], None, 0, 0
    for x in values:
        gap += 1
        if x is not None:
            w = (1 - alpha) ** gap
            y, gap, seen = (x if y is None else (w * y + alpha * x) / (w + alpha)), 0, seen + 1
        out.append(y if seen >= need else None)
    return out


@pytest.mark.parametrize("rows_per_block", [4096, 150])
@pytest.mark.parametrize("alpha", [0.01, 0.2, 2 / 3, 1.0])
def test_weighted_mean_with_gaps(spark, alpha, rows_per_block):
    rng = random.Random(5)
    values = [None if rng.random() < 0.3 else rng.uniform(-50, 50) for _ in range(900)]
    values[:7] = [None] * 7
    values[300:560] = [None] * 260  # whole blocks without a value
    rows = [(START + timedelta(days=i), "A", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "date date, symbol string, x double")
    scans = [Ewm("y", "x", alpha, 14, ANYWHERE), Total("total", "x")]
    got = ewm(df, scans, rows=rows_per_block).orderBy("date").collect()
    want, total = by_hand(values, alpha, 14), 0.0
    for r, v, w in zip(got, values, want):
        total += v or 0.0
        assert (r["y"] is None) == (w is None)
        assert w is None or math.isclose(r["y"], w, rel_tol=1e-9, abs_tol=1e-9)
        assert r["total"] is None or math.isclose(r["total"], total, abs_tol=1e-8)


def test_block_length_limit():
    assert block_rows_for([Ewm("y", "x", 0.9)], 4096) == 249
    assert block_rows_for([Ewm("y", "x", 0.001)], 4096) == 4096


def _closes(spark, values, symbol="A"):
    rows = [(symbol, datetime.date(2020, 1, 1) + datetime.timedelta(days=i), str(v)) for i, v in enumerate(values)]
    names = "symbol string, date date, close string"
    cols = [F.col("close").alias(c) for c in ("open", "high", "low", "ltp", "vol")]
    return spark.createDataFrame(rows, names).select("*", *cols)


def test_closes_that_are_no_numbers(spark):
    closes = [100 + (i * 7) % 13 for i in range(60)]
    for bad in ("NaN", "n/a"):
        values = [bad if i == 20 else c for i, c in enumerate(closes)]
        got = I.compute(load_series(_closes(spark, values)), [I.ema(9), I.sma(5)]).orderBy("date").toPandas()
        want = pd.Series([np.nan if v == bad else v for v in values], dtype=float)
        np.testing.assert_allclose(got["ema_9"], want.ewm(span=9, adjust=False).mean(), rtol=1e-9)
        np.testing.assert_allclose(got["sma_5"].astype(float), want.rolling(5).mean(), rtol=1e-9)


def test_two_instances_of_one_indicator(spark):
    series = load_series(_closes(spark, [100 + (i * 7) % 13 for i in range(80)]))
    pairs = [
        (I.adx(14), I.adx(5)), (I.macd(), I.macd(5, 10, 4)), (I.bollinger(20), I.bollinger(10)), (I.sma(5), I.sma(5, "high")),
    ]
    for one, two in pairs:
        with pytest.raises(ValueError):
            I.compute(series, [one, two])
        both = I.compute(series, [one, I.renamed(two, "_b")]).orderBy("date").toPandas()
        alone = I.compute(series, [two]).orderBy("date").toPandas()
        first = I.compute(series, [one]).orderBy("date").toPandas()
        for name in two.outputs:
            np.testing.assert_allclose(both[name + "_b"].astype(float), alone[name].astype(float))
        for name in one.outputs:
            np.testing.assert_allclose(both[name].astype(float), first[name].astype(float))


def test_rows_without_a_date_leave_the_split_alone(spark):
    series = load_series(_closes(spark, [100 + i % 9 for i in range(600)]))
    stray = spark.createDataFrame([("A", None)] , "symbol string, date date").select(
        "date", "symbol", *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "ltp", "vol")]
    )
    mixed = series.unionByName(stray)
    whole = I.compute(mixed, [I.sma(5)]).orderBy("date").toPandas()
    split = I.compute(mixed, [I.sma(5)], rows=200).orderBy("date").toPandas()
    assert len(whole) == len(split) == 600
    np.testing.assert_allclose(whole["sma_5"].astype(float), split["sma_5"].astype(float))
