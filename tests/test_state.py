"""Runs that go on from stored states against computing everything anew."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.operators import indicators as I
from barloom.plans import state
from barloom.plans.incremental import compute_all_indicators, run_daily, run_refresh
from barloom.schema import INDICATOR_COLUMNS, INDICATORS, STOCK_BARS, align_to_schema
from barloom.sinks.tables import read_table, stored_counts, stored_incomplete_dates, write_upsert
from barloom.sources.bars import load_series
from barloom.streaming.jobs import stream_indicators
from test_indicators import SCHEMA

D0 = date(2015, 1, 1)


def walk(seed, days, density):
    rng = random.Random(seed)
    rows = []
    for s, dense in density.items():
        price = 100.0
        for k in range(days):
            if rng.random() < dense:
                price *= 1 + rng.gauss(0, 0.02)
                high = price * (1 + 0.02 * rng.random()) if rng.random() > 0.01 else None
                vol = float(rng.randint(1, 999)) if rng.random() > 0.02 else None
                rows.append((D0 + timedelta(k), s, price, high, price * 0.99, price, price, vol))
    return rows


class Tables:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.bars, self.indicators, self.state = (f"{self.root}/{n}" for n in ("bars", "indicators", "state"))

    def put(self, rows, path=None):
        df = self.spark.createDataFrame(rows, SCHEMA)
        write_upsert(align_to_schema(df, STOCK_BARS), path or self.bars, STOCK_BARS)

    def full(self):
        return compute_all_indicators(load_series(read_table(self.spark, self.bars, STOCK_BARS)))

    def stored(self):
        return read_table(self.spark, self.indicators, INDICATORS)


def same(got, want):
    got, want = ({(r["symbol"], r["date"]): r for r in df.collect()} for df in (got, want))
    assert got.keys() == want.keys()
    for k, w in want.items():
        for c in INDICATOR_COLUMNS:
            g = got[k][c]
            assert (g is None) == (w[c] is None) and (g is None or g == pytest.approx(w[c], rel=1e-9, abs=1e-9)), (k, c)


@pytest.fixture()
def small_epochs(monkeypatch):
    real = state.advance

    def advance(*args, **kwargs):
        return real(*args, **{"epoch_days": 64, "rows": 400} | kwargs)

    monkeypatch.setattr("barloom.plans.incremental.advance", advance)


def test_refresh_equals_full_history(spark, tmp_path, small_epochs):
    """Dense and sparse series, deliveries of many days and of one, late bars in old epochs, a new series."""
    t = Tables(spark, tmp_path)
    rows = walk(1, 330, {"A": 1.0, "B": 0.6, "C": 0.1})
    rng = random.Random(2)
    late = set(rng.sample(range(len(rows)), 5))
    first = [r for k, r in enumerate(rows) if k not in late]
    cuts = [D0, D0 + timedelta(280), D0 + timedelta(281), D0 + timedelta(900)]
    for a, b in zip(cuts, cuts[1:]):
        t.put([r for r in first if a <= r[0] < b])
        assert run_refresh(spark, t.bars, t.indicators, t.state) == 0
    same(t.stored(), t.full())
    t.put([rows[k] for k in late] + walk(3, 100, {"NEW": 0.5}))
    assert run_refresh(spark, t.bars, t.indicators, t.state) > 0
    same(t.stored(), t.full())
    before = t.stored().count()
    assert run_refresh(spark, t.bars, t.indicators, t.state) == 0 and t.stored().count() == before


def test_a_run_that_failed_is_repeated(spark, tmp_path, small_epochs, monkeypatch):
    t = Tables(spark, tmp_path)
    rows = walk(5, 150, {"A": 1.0, "B": 0.3})
    t.put([r for r in rows if r[0] < D0 + timedelta(100)])
    run_refresh(spark, t.bars, t.indicators, t.state)
    t.put([r for r in rows if r[0] >= D0 + timedelta(100)])
    # The states are written, the keys of the run are not.
    with monkeypatch.context() as m:
        m.setattr(state.StateTable, "add_keys", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_refresh(spark, t.bars, t.indicators, t.state)
    assert run_refresh(spark, t.bars, t.indicators, t.state) == 2
    same(t.stored(), t.full())


def test_a_daily_run_reads_its_day_only(spark, tmp_path):
    t = Tables(spark, tmp_path)
    rows = walk(7, 230, {"A": 1.0, "B": 1.0})
    days = [D0 + timedelta(k) for k in (227, 228, 229)]
    t.put([r for r in rows if r[0] <= days[0]])
    run_daily(spark, t.bars, t.indicators, days[0], t.state)
    assert {r[0] for r in t.stored().select("date").distinct().collect()} == {days[0]}
    # From here on the older bars are out of reach: the next days lie in a table of their own.
    other = f"{t.root}/last-days"
    for day in days[1:]:
        t.put([r for r in rows if r[0] == day], other)
        run_daily(spark, other, t.indicators, day, t.state)
    t.put(rows)
    same(t.stored(), t.full().where(F.col("date").isin(days)))
    # A row that was lost is computed from the whole history.
    lost = t.stored().where(F.col("date") != F.lit(days[2]))
    spark.createDataFrame(lost.collect(), INDICATORS).write.partitionBy("date").parquet(f"{t.root}/lost")
    run_daily(spark, t.bars, f"{t.root}/lost", days[2], t.state)
    same(read_table(spark, f"{t.root}/lost", INDICATORS), t.full().where(F.col("date").isin(days)))


def test_stream_with_a_late_file(spark, tmp_path):
    t = Tables(spark, tmp_path)
    rows = walk(9, 60, {"A": 1.0, "B": 0.5})
    late = [r for r in rows if r[0].day == 9]
    for part in ([r for r in rows if r not in late and r[0] < D0 + timedelta(40)], [r for r in rows if r not in late and r[0] >= D0 + timedelta(40)], late):
        df = align_to_schema(spark.createDataFrame(part, SCHEMA), STOCK_BARS)
        df.write.mode("append").partitionBy("date").parquet(t.bars)
        stream_indicators(spark, t.bars, t.indicators, f"{t.root}/checkpoint").awaitTermination()
    same(t.stored(), t.full())


def test_another_set_of_indicators_has_states_of_its_own(spark, tmp_path):
    t = Tables(spark, tmp_path)
    t.put(walk(11, 40, {"A": 1.0}))
    for wanted in ([I.ema(9)], [I.ema(5), I.rsi(5)]):
        change = state.advance(spark, t.bars, t.state, indicators=wanted)
        want = I.compute(load_series(read_table(spark, t.bars, STOCK_BARS)), wanted)
        got = {r["date"]: r[wanted[-1].outputs[0]] for r in change.rows.collect()}
        assert got == pytest.approx({r["date"]: r[wanted[-1].outputs[0]] for r in want.collect()})
        change.commit()
        assert state.advance(spark, t.bars, t.state, indicators=wanted).rows.count() == 0


def test_empty_and_odd_bars(spark, tmp_path):
    t = Tables(spark, tmp_path)
    assert run_refresh(spark, t.bars, t.indicators, t.state) == 0
    t.put([(D0, None, *[1.0] * 6), (D0, "A", 1.0, 1.0, 1.0, None, 1.0, 1.0), (D0, "B", *[2.0] * 6)])
    run_refresh(spark, t.bars, t.indicators, t.state)
    assert [r["symbol"] for r in t.stored().collect()] == ["B"]
    t.put([(D0, "A", *[1.0] * 6)])
    run_refresh(spark, t.bars, t.indicators, t.state)
    # The day has as many bars as before, so the change is not seen; a row more shows it.
    t.put([(D0, "C", *[1.0] * 6)])
    run_refresh(spark, t.bars, t.indicators, t.state)
    assert sorted(r["symbol"] for r in t.stored().collect()) == ["A", "B", "C"]


def test_counts_from_footers(spark, tmp_path):
    t = Tables(spark, tmp_path)
    assert stored_counts(spark, t.bars, STOCK_BARS).count() == 0
    t.put([(D0, "A", *[1.0] * 6), (D0, "B", *[1.0] * 5, None), (D0 + timedelta(1), "A", *[1.0] * 6)])
    counts = stored_counts(spark, t.bars, STOCK_BARS, ("vol",))
    assert sorted(map(tuple, counts.collect())) == [(D0, 2, 1), (D0 + timedelta(1), 1, 1)]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(" in plan and "PushedGroupBy: [date]" in plan
    short = stored_incomplete_dates(spark, t.bars, STOCK_BARS, ("close", "vol"))
    assert [r[0] for r in short.collect()] == [D0]
    assert stored_incomplete_dates(spark, t.bars, STOCK_BARS, ("rsi_14",)).count() == 0
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
