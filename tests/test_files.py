"""Daily files: deliveries into one folder, and which files are opened."""

from datetime import date

import pytest

from barloom.plans.incremental import ingest_history
from barloom.schema import STOCK_BARS, STOCK_HEADERS
from barloom.sinks.exports import write_table_csv
from barloom.sinks.tables import read_table
from barloom.sources.bars import read_index_bars, read_stock_bars, stock_table
from barloom.sources.csv_files import columns_of, read_cells, read_files
from barloom.streaming.jobs import stream_ingest

CELLS = {column: header for header, column in STOCK_HEADERS.items()}
DAY = date(2024, 1, 2)


def deliver(spark, path, close, days=(DAY,), parts=1):
    rows = [(d, f"S{k}", close + k) for d in days for k in range(4)]
    df = spark.createDataFrame(rows, "date date, symbol string, close double").repartition(parts)
    df.select("date", df.symbol.alias("Symbol"), df.close.alias("Close")).write.mode("append").partitionBy("date").option("header", True).csv(path)


def closes(rows):
    return {(r["date"], r["symbol"]): r["close"] for r in rows.collect()}


@pytest.mark.parametrize("attempt", range(10))
def test_the_later_delivery_into_a_folder_counts(spark, tmp_path, attempt):
    files = str(tmp_path / "files")
    deliver(spark, files, 10.0, parts=1 + attempt % 3)
    deliver(spark, files, 20.0, parts=1 + attempt % 2)
    want = {(DAY, f"S{k}"): 20.0 + k for k in range(4)}
    assert closes(stock_table(read_stock_bars(spark, files))) == want
    ingest_history(spark, files, str(tmp_path / "bars"))
    assert closes(read_table(spark, str(tmp_path / "bars"), STOCK_BARS)) == want


def test_a_correction_that_is_taken_back(spark, tmp_path):
    files = str(tmp_path / "files")
    for close in (10.0, 20.0, 10.0):
        deliver(spark, files, close)
    ingest_history(spark, files, str(tmp_path / "bars"))
    stream_ingest(spark, files, str(tmp_path / "streamed"), str(tmp_path / "checkpoint"))
    want = {(DAY, f"S{k}"): 10.0 + k for k in range(4)}
    for table in ("bars", "streamed"):
        assert closes(read_table(spark, str(tmp_path / table), STOCK_BARS)) == want


def test_written_tables_are_deliveries(spark, tmp_path):
    bars = spark.createDataFrame([(DAY, "A", 1.0)], "date date, symbol string, close double")
    write_table_csv(bars, str(tmp_path / "f"), CELLS)
    write_table_csv(bars.withColumn("close", bars.close + 1), str(tmp_path / "f"), CELLS)
    assert closes(stock_table(read_stock_bars(spark, str(tmp_path / "f")))) == {(DAY, "A"): 2.0}


def opened(df):
    """Files that the scan of ``df`` reads."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        metric = node.metrics().get("numFiles")
        n += metric.get().value() if metric.isDefined() else 0
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
    return n


def test_one_date_opens_its_files_only(spark, tmp_path):
    days = [date(2024, m, d) for m in (1, 11) for d in (1, 2, 11, 12)]
    deliver(spark, str(tmp_path / "f"), 10.0, days)
    for name in ("2024-1-1.csv", "2024_01_11.csv", "20240101.csv", "2024_1_01.csv"):
        (tmp_path / "f" / name).write_text("Symbol,Close\nX,5\n")
    one = read_stock_bars(spark, str(tmp_path / "f"), date(2024, 1, 1))
    assert opened(one) == 4 and {r["date"] for r in one.collect()} == {date(2024, 1, 1)}
    assert {r["symbol"] for r in one.collect()} == {"S0", "S1", "S2", "S3", "X"}
    assert opened(read_stock_bars(spark, str(tmp_path / "f"))) == len(days) + 4
    assert opened(read_stock_bars(spark, str(tmp_path / "f"), date(2023, 1, 1))) == 0


def test_columns_are_found_while_a_file_is_parsed(spark, tmp_path):
    for name, text in {
        "a.csv": "﻿ Close ,Symbol\n1,A\n2\n",
        "b.csv": "title\nx,Symbol,Close\n0,B,3,extra\n",
        "c.csv": "Close\n5\n",
        "d.csv": "",
        "e.csv": 'Symbol,Close\n"two\nlines","1,000"\n',
    }.items():
        (tmp_path / name).write_text(text)
    rows = columns_of(read_files(spark, str(tmp_path)), ("Symbol",), {"Symbol": "symbol", "Close": "close", "High": "high"})
    got = {(r["file"][-5:], r["symbol"], r["close"], r["high"]) for r in rows.collect()}
    assert got == {
        ("a.csv", "A", "1", None), ("a.csv", None, "2", None), ("b.csv", "B", "3", None), ("b.csv", None, None, None),
        ("e.csv", "two\nlines", "1,000", None),
    }
    plan = stock_table(read_stock_bars(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and plan.count("FileScan") == 1
    assert read_index_bars(spark, str(tmp_path)).count() == 0
    assert read_cells(spark, str(tmp_path)).select("file").distinct().count() == 4
