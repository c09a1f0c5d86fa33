"""Late and disordered rows of the streaming mean, across restarts of the stream."""

import random
from datetime import date, timedelta

import pytest

from barloom.catalog.streams import _ewm_stream
from barloom.operators.recurrence import span_alpha
from barloom.streaming import jobs

D0 = date(2024, 1, 1)


def mean_of(values, alpha):
    y, gap, out = None, 0, []
    for x in values:
        gap += 1
        if x is not None:
            w = (1 - alpha) ** gap
            y = x if y is None else (w * y + alpha * x) / (w + alpha)
            gap = 0
        out.append(y)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "symbol string, date date, x double")


def test_rows_within_the_delay_are_put_in_order(spark, tmp_path):
    rng = random.Random(3)
    rows = [(s, D0 + timedelta(k), None if rng.random() < 0.1 else rng.uniform(1, 9)) for s in ("a", "b") for k in range(40)]
    # Rows come in three deliveries, each shifted by up to four days.
    parts = [[], [], []]
    for r in rows:
        k = (r[1] - D0).days + rng.randint(0, 4)
        parts[min(2, k // 15)].append(r)
    for p in parts:
        rng.shuffle(p)
    out = _ewm_stream(str(tmp_path / "s"), [frame(spark, p) for p in parts], delay_days=5).collect()
    got = {(r["symbol"], r["date"]): r for r in out}
    assert len(got) == len(out) and not any(r["late"] for r in out)
    assert set(got) == {(s, d) for s, d, _ in rows if d <= D0 + timedelta(39 - 5)}
    for s in ("a", "b"):
        mine = sorted(r for r in rows if r[0] == s)
        for (_, d, _), y in zip(mine, mean_of([x for _, _, x in mine], span_alpha(9))):
            if (s, d) in got:
                assert got[s, d]["ema_9"] == (None if y is None else pytest.approx(y, rel=1e-12))


def test_rows_behind_the_delay_are_marked(spark, tmp_path):
    first = [("a", D0 + timedelta(k), float(k)) for k in range(20) if k != 5]
    late = [("a", D0 + timedelta(5), 5.0), ("a", D0 + timedelta(3), 3.0), ("a", D0 + timedelta(19), 7.0), ("a", None, 1.0), ("a", D0 + timedelta(30), None)]
    out = _ewm_stream(str(tmp_path / "s"), [frame(spark, first), frame(spark, late)], delay_days=4).collect()
    marked = [(r["date"], r["x"], r["ema_9"]) for r in out if r["late"]]
    # Of the two rows of one day the lesser counts.
    assert sorted(marked, key=str) == sorted([(D0 + timedelta(5), 5.0, None), (D0 + timedelta(3), 3.0, None), (None, 1.0, None), (D0 + timedelta(19), 19.0, None)], key=str)
    used = {r["date"]: r["ema_9"] for r in out if not r["late"]}
    assert sorted(used) == [D0 + timedelta(k) for k in range(20) if k != 5]
    want = mean_of([float(k) for k in range(19) if k != 5] + [7.0], span_alpha(9))
    assert used[D0 + timedelta(19)] == pytest.approx(want[-1], rel=1e-12)


def test_without_a_delay_rows_are_used_as_they_come(spark, tmp_path):
    parts = [[("a", D0 + timedelta(2), 2.0), ("a", D0, 0.0)], [("a", D0 + timedelta(1), 1.0), ("a", D0 + timedelta(3), 3.0)]]
    out = {r["date"]: r for r in _ewm_stream(str(tmp_path / "s"), [frame(spark, p) for p in parts]).collect()}
    assert [out[D0 + timedelta(k)]["late"] for k in range(4)] == [False, True, False, False]
    assert out[D0 + timedelta(3)]["ema_9"] == pytest.approx(mean_of([0.0, 2.0, 3.0], span_alpha(9))[-1])


def test_series_share_a_key_of_the_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "SERIES_GROUPS", 2)
    rng = random.Random(5)
    rows = [(s, D0 + timedelta(k), None if rng.random() < 0.2 else rng.uniform(1, 9)) for s in (*"abcdefg", None) for k in range(12)]
    rng.shuffle(rows)
    rows.sort(key=lambda r: (r[1] - D0).days // 6)
    parts = [rows[: len(rows) // 2], rows[len(rows) // 2 :]]
    for delay in (None, 3):
        out = _ewm_stream(str(tmp_path / f"s{delay}"), [frame(spark, p) for p in parts], delay_days=delay).collect()
        got = {(r["symbol"], r["date"]): r for r in out}
        last = D0 + timedelta(11 - (delay or 0))
        assert len(got) == len(out) and set(got) == {r[:2] for r in rows if r[1] <= last} and not any(r["late"] for r in out)
        for s in (*"abcdefg", None):
            mine = sorted((r for r in rows if r[0] == s), key=lambda r: r[1])
            for (_, d, _), y in zip(mine, mean_of([x for _, _, x in mine], span_alpha(9))):
                if d <= last:
                    assert got[s, d]["ema_9"] == (None if y is None else pytest.approx(y, rel=1e-12))
