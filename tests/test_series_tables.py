"""Tables stored by series, folds over series, hashes of large files, and the jobs' command line."""

import hashlib
import os
import uuid
from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom import jobs
from barloom.operators.extension import fold_per_series
from barloom.plans.incremental import compute_all_indicators, rows_to_backfill
from barloom.schema import INDICATORS, STOCK_BARS, STOCK_HEADERS, align_to_schema
from barloom.sinks.buckets import by_series, create_series_table, read_series_table, upsert_series, write_upsert_series
from barloom.sinks.exports import write_table_csv
from barloom.sinks.tables import read_table
from barloom.sources import files
from barloom.sources.bars import load_series
from test_indicators import SCHEMA, walk

D0 = date(2024, 1, 1)


def stored(spark, tmp_path, rows, name):
    table = f"t_{uuid.uuid4().hex}"
    create_series_table(rows, table, str(tmp_path / name), 4)
    return table


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]


def test_series_tables_need_no_shuffle(spark, tmp_path):
    rows = [r for k, s in enumerate("ABC") for r in walk(s, 500, k)]
    bars = align_to_schema(spark.createDataFrame(rows, SCHEMA), STOCK_BARS)
    table = stored(spark, tmp_path, bars, "bars")
    read = read_series_table(spark, table)
    assert read.columns == bars.columns
    everything = compute_all_indicators(load_series(read))
    assert not shuffles(everything) and not shuffles(compute_all_indicators(load_series(read), 400))
    cut = F.lit(date(2016, 3, 1))
    done = stored(spark, tmp_path, compute_all_indicators(load_series(read.where(F.col("date") < cut))), "indicators")
    with by_series(spark):
        due = rows_to_backfill(read, read_series_table(spark, done))
        assert not shuffles(due)
        assert not shuffles(upsert_series(due, read_series_table(spark, done)))
        due = spark.createDataFrame(due.collect(), due.schema)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    write_upsert_series(due, done)
    got = read_series_table(spark, done)
    assert got.count() == everything.count()
    keys = ["symbol", "date"]
    pd.testing.assert_frame_equal(
        got.orderBy(*keys).toPandas()[everything.columns], everything.orderBy(*keys).toPandas(), rtol=1e-9, check_dtype=False
    )
    # Still by series: the files keep their buckets.
    assert not shuffles(load_series(read_series_table(spark, table)).groupBy("symbol").count())


def test_upsert_replaces_rows_of_its_years(spark, tmp_path):
    schema = "date date, symbol string, close double"
    rows = [(D0 + timedelta(200 * k), s, 1.0) for k in range(5) for s in ("A", "B", None)] + [(None, "A", 1.0)]
    table = stored(spark, tmp_path, spark.createDataFrame(rows, schema), "t")
    new = [(D0 + timedelta(400), "A", 2.0), (D0 + timedelta(401), "C", 3.0)]
    write_upsert_series(spark.createDataFrame(new, schema), table)
    write_upsert_series(spark.createDataFrame([], schema), table)
    got = sorted(map(str, read_series_table(spark, table).collect()))
    want = [r for r in rows if r[:2] != new[0][:2]] + new
    assert got == sorted(map(str, spark.createDataFrame(want, schema).collect()))


def fold(spark, df, sizes, **options):
    """Running totals, the sizes of the frames and a last row per series."""

    def step(total, frame):
        sizes.add(len(frame))
        sums = frame["x"].fillna(0).cumsum() + total[1]
        return (frame["symbol"].iloc[0], float(sums.iloc[-1])), frame[["symbol", "date"]].assign(total=sums)

    last = lambda s: pd.DataFrame({"symbol": [s[0]], "date": [None], "total": [s[1]]})
    return fold_per_series(df, lambda: (None, 0.0), step, "symbol string, date date, total double", end=last, **options)


def test_fold_carries_its_state_between_frames(spark):
    rows = [(s, D0 + timedelta(k), None if k % 7 == 0 else float(k)) for s in ("a", "b", None) for k in range(95)] + [("a", None, 5.0), ("c", D0, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, date date, x double").repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = fold(spark, df, set()).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for s in ("a", "b", "c", None):
        mine = sorted((r for r in rows if r[0] == s), key=lambda r: (r[1] is not None, r[1] or D0))
        total, want = 0.0, []
        for _, d, x in mine:
            total += x or 0.0
            want.append((d, total))
        want.append((None, total))
        out = [(r["date"], r["total"]) for r in got if r["symbol"] == s]
        assert sorted(out, key=str) == sorted(want, key=str)
    assert fold(spark, df.limit(0), set()).count() == 0


def test_fold_of_a_long_series_in_bounded_frames(spark):
    df = spark.range(2_000_000).selectExpr("'a' AS symbol", "date_add(DATE '1970-01-01', CAST(id % 40000 AS INT)) AS date", "1D AS x", "id")

    def step(state, frame):
        return (state[0] + len(frame), max(state[1], len(frame))), None

    end = lambda s: pd.DataFrame({"rows": [s[0]], "largest": [s[1]]})
    out = fold_per_series(df, lambda: (0, 0), step, "rows long, largest long", end=end).collect()
    assert [(r["rows"], r["largest"] <= 10_000) for r in out] == [(2_000_000, True)]


def test_hashes_of_files_of_any_size(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    contents = {f"f {k}.csv": os.urandom(n) for k, n in enumerate((1, 1000, 5000))}
    for name, data in contents.items():
        (tmp_path / "in" / name).write_bytes(data)
    want = {name: (len(data), hashlib.md5(data).hexdigest()) for name, data in contents.items()}
    for limit in (10, 1 << 20):
        monkeypatch.setattr(files, "WHOLE_BYTES", limit)
        got = files.file_hash(spark, str(tmp_path / "in")).collect()
        assert {os.path.basename(r["file"]): (r["bytes"], r["md5"]) for r in got} == want


def test_a_file_over_two_gigabytes(spark, tmp_path):
    size = (2 << 30) + 12_345
    with open(tmp_path / "large.csv", "wb") as f:
        f.truncate(size)  # a hole, it takes no disk
    digest = hashlib.md5()
    for n in [1 << 24] * (size >> 24) + [size & ((1 << 24) - 1)]:
        digest.update(bytes(n))
    assert [(r["bytes"], r["md5"]) for r in files.file_hash(spark, str(tmp_path)).collect()] == [(size, digest.hexdigest())]


def test_jobs(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("files", "bars", "one", "streamed", "check", "ind", "refreshed", "states", "one_day", "late", "c2")}
    rows = [(D0 + timedelta(k), s, 10.0 + 0.25 * k) for k in range(12) for s in ("A", "B")]
    frame = spark.createDataFrame(rows, "date date, symbol string, close double")
    prices = frame.select("*", *[F.col("close").alias(c) for c in ("open", "high", "low", "ltp", "vol")])
    write_table_csv(prices, paths["files"], {column: header for header, column in STOCK_HEADERS.items()})
    last = str(D0 + timedelta(11))

    def job(*args):
        assert jobs.main([paths.get(a, a) for a in args]) == 0

    def rows_of(path, schema=INDICATORS):
        return sorted(map(str, read_table(spark, paths[path], schema).select("date", "symbol").collect()))

    every = sorted(map(str, frame.select("date", "symbol").collect()))
    job("ingest-history", "files", "bars")
    job("stream-ingest", "files", "streamed", "check")
    assert rows_of("bars", STOCK_BARS) == every == rows_of("streamed", STOCK_BARS)
    job("ingest-today", last, "--stock-files", "files", "--stock-table", "one")
    assert len(rows_of("one", STOCK_BARS)) == 2
    job("backfill", "bars", "ind")
    job("refresh", "bars", "refreshed", "states")
    job("stream-indicators", "bars", "late", "c2")
    assert rows_of("ind") == every == rows_of("refreshed") == rows_of("late")
    job("daily", "bars", "one_day", last, "--state", "states")
    assert len(rows_of("one_day")) == 2
    with pytest.raises(ValueError):
        job("ingest-today", last, "--stock-files", "files")
    with pytest.raises(SystemExit):
        job("unknown")
