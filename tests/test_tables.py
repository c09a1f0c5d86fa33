"""Files, pages, tables and jobs on small fixtures written by the tests."""

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barloom.functions import calendar as C
from barloom.functions import clean as P
from barloom.operators import completeness as G
from barloom.operators import dedupe as D
from barloom.plans.incremental import ingest_history, ingest_today, rows_to_backfill, run_backfill, run_daily
from barloom.schema import INDEX_BARS, INDICATORS, STOCK_BARS, align_to_schema
from barloom.sinks import exports, tables
from barloom.sources.bars import read_index_bars, read_stock_bars, stock_table
from barloom.sources.csv_files import read_cells
from barloom.sources.files import file_hash
from barloom.sources.pages import extract_records, extract_table, extract_tables_union
from barloom.sources.reports import read_top10_report
from barloom.streaming import jobs
from barloom.streaming.jobs import stream_ingest, stream_indicators
from test_indicators import walk

HEADER = (
    "S.No,Symbol,Conf.,Open,High,Low,Close,LTP,Close - LTP,Close - LTP %,VWAP,Vol,Prev. Close,Turnover,"
    "Trans.,Diff,Range,Diff %,Range %,VWAP %,52 Weeks High,52 Weeks Low"
)


def line(symbol, close, turnover='"1,234.50"'):
    return f"1,{symbol},40,1,2,0.5,{close},3,0,-,1.5,100,,{turnover},7,1,1,1,1,1,9,"


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_stock_files(spark, tmp_path):
    d = tmp_path / "stock"
    write(d, "2020_01_05.csv", HEADER, line("AAA", 10), line("", 5), line("BBB", '"1,000"'))
    write(d, "2020-01-06.csv", HEADER, "No Record Found.")
    write(d, "20200107.csv", HEADER, line("AAA", "text"), "1,SHORT,40")
    write(d, "notes.csv", HEADER, line("AAA", 99))
    write(d, "2020_01_08.csv", "Close, Symbol ,Unknown", "5,AAA,x")
    rows = {(str(r["date"]), r["symbol"]): r for r in read_stock_bars(spark, str(d)).collect()}
    assert sorted(rows) == [
        ("2020-01-05", "AAA"), ("2020-01-05", "BBB"), ("2020-01-07", "AAA"), ("2020-01-07", "SHORT"),
        ("2020-01-08", "AAA"),
    ]
    first = rows["2020-01-05", "AAA"]
    assert (first["close"], first["turnover"], first["close_minus_ltp_pct"]) == (10, 1234.5, None)
    assert rows["2020-01-05", "BBB"]["close"] == 1000 and first["weeks_52_low"] is None
    assert rows["2020-01-07", "AAA"]["close"] is None and rows["2020-01-07", "SHORT"]["open"] is None
    assert rows["2020-01-08", "AAA"]["close"] == 5
    # Two files of one date: the one whose name sorts last wins.
    write(d, "20200105.csv", HEADER, line("AAA", 11))
    best = stock_table(read_stock_bars(spark, str(d))).where("symbol = 'AAA' AND date = DATE '2020-01-05'")
    assert [r["close"] for r in best.collect()] == [10]


def test_empty_days_share_a_fingerprint(spark, tmp_path):
    d = tmp_path / "empty"
    for name in ("2020_01_01.csv", "2020_01_02.csv"):
        write(d, name, HEADER, "No Record Found.")
    write(d, "2020_01_03.csv", "No Record Found.  ", HEADER)
    assert read_stock_bars(spark, str(d)).count() == 0
    prints = D.content_fingerprint(read_cells(spark, str(d)))
    assert prints.select("fingerprint").distinct().count() == 1
    assert [r["file"][-14:] for r in D.find_duplicates(prints).orderBy("file").collect()] == [
        "2020_01_02.csv", "2020_01_03.csv",
    ]
    assert D.duplicate_summary(prints).first().asDict() == {"files": 3, "duplicates": 2, "remaining": 1}
    hashes = file_hash(spark, str(d)).orderBy("file").collect()
    assert hashes[0]["md5"] == hashes[1]["md5"] != hashes[2]["md5"]


def test_index_files(spark, tmp_path):
    d = tmp_path / "index"
    write(d, "2020_01_01.csv", "Index,Current,Point Change,% Change,Turnover", 'Main Index,"2,500.25",12.5,0.75,"987,654.00"')
    write(d, "2020_01_02.csv", "index,current,point_change,pct_change,turnover", "Main Index,n/a,1,2,")
    one, two = read_index_bars(spark, str(d)).orderBy("date").collect()
    assert (one["current"], one["turnover"], one["_corrupt"]) == (2500.25, 987654.0, False)
    assert (two["current"], two["point_change"], two["turnover"], two["_corrupt"]) == (None, 1, None, True)


def test_top10_report(spark, tmp_path):
    d = tmp_path / "reports"
    write(d, "a.csv", '.,"Exchange', 'City",,', ",,,", "S.N.,SECURITY_NAME,SYMBOL,AMOUNT", "1,First Ltd,FST,9000.5", "2,Second Ltd,SCD,8000.25")
    write(d, "b.csv", "Unnamed,,Exchange,,,,", "S.N. ,Name ,,,Symbol,,Amount", "1,Third  Ltd,,,TRD,,7000.75")
    got = [tuple(r)[1:] for r in read_top10_report(spark, str(d)).orderBy("file", "rank").collect()]
    assert got == [(1, "First Ltd", "FST", 9000.5), (2, "Second Ltd", "SCD", 8000.25), (1, "Third  Ltd", "TRD", 7000.75)]


def test_pages(spark):
    def t(head, *rows):
        body = "".join("<tr>" + "".join(f"<td> {c}\n</td>" for c in r) + "</tr>" for r in rows)
        return f"<table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>"

    head = "<th>A</th><th>B</th>"
    pages = [
        (1, "<p>x</p>" + t(head, ["1", "a&amp;b"], ["2"], ["3", "c", "d"])),
        (2, t(head, ["1", "2"]) + t(head, ["3", "4"]) + t("<th>C</th>", ["5"])),
        (3, "<table><tr><th>A</th></tr><tr><td>7</td></tr></table>"),
        (4, t(head, ["No Record Found."])),
        (5, "<div>nothing</div>"),
        (6, "<table><tr><th>A</th></tr></table>"),
        (7, t(head, ["1", "no data found here"])),
        (8, None),
    ]
    df = spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string")
    first = [(r["page_id"], r["row_no"], r["cells"]) for r in extract_table(df).orderBy("page_id", "row_no").collect()]
    assert first == [
        (1, 1, ["A", "B"]), (1, 2, ["1", "a&b"]), (1, 3, ["2"]), (1, 4, ["3", "c", "d"]),
        (2, 1, ["A", "B"]), (2, 2, ["1", "2"]), (3, 1, ["A"]), (3, 2, ["7"]),
    ]
    union = [(r["page_id"], r["table_no"], r["cells"]) for r in extract_tables_union(df).orderBy("page_id", "table_no").collect()]
    assert union == [(1, 0, ["1", "a&b"]), (2, 0, ["1", "2"]), (2, 1, ["3", "4"])]
    records = [(r["page_id"], r["record"]) for r in extract_records(df).orderBy("page_id", "row_no").collect()]
    assert records[:3] == [(1, {"A": "1", "B": "a&b"}), (1, {"A": "3", "B": "c"}), (2, {"A": "1", "B": "2"})]


def test_numbers_and_dates(spark):
    cells = ["1,234.5", " 7 ", "", None, "-", "nan", "inf", "1d", "1_000", "-.5e2", "5."]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in cells], "c string").select(P.parse_number(F.col("c"))).collect()]
    assert got == [1234.5, 7, None, None, None, None, None, None, None, -50, 5]
    names = ["a/2020_1_5.csv", "a/2020-01-05.CSV", "20200105.csv", "x.csv", "2020_13_01.csv", "a/date=2020-01-05/part-0.csv"]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in names], "c string").select(P.date_from_filename(F.col("c"))).collect()]
    day = date(2020, 1, 5)
    assert got == [day, day, day, None, None, day]


def test_calendar(spark):
    days = [r[0] for r in C.trading_days(spark, date(2024, 1, 1), date(2024, 1, 9)).collect()]
    assert [d.day for d in days] == [1, 2, 3, 4, 7, 8, 9]
    held = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 3, 8)], "date date")
    assert [r[0].day for r in C.missing_trading_days(held).orderBy("date").collect()] == [2, 4, 7]
    got = held.select(C.latest_trading_day(F.lit(date(2024, 1, 6)))).first()[0]
    assert got == date(2024, 1, 4)


def test_schema_growth_and_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(date(2024, 1, 1), "A", 1.0), (date(2024, 1, 2), "A", 2.0)], "date date, symbol string, rsi_14 double")
    old.write.partitionBy("date").parquet(path)
    new = spark.createDataFrame([(date(2024, 1, 2), "A", 9.0), (date(2024, 1, 2), "B", 8.0)], "date date, symbol string, ema_9 double")
    tables.write_upsert(new, path, INDICATORS)
    rows = tables.read_table(spark, path, INDICATORS).orderBy("date", "symbol").collect()
    assert [(r["date"].day, r["symbol"], r["rsi_14"], r["ema_9"]) for r in rows] == [
        (1, "A", 1.0, None), (2, "A", None, 9.0), (2, "B", None, 8.0),
    ]
    tables.write_new_dates(new.withColumn("date", F.lit(date(2024, 1, 2))), path, INDICATORS)
    assert tables.read_table(spark, path, INDICATORS).count() == 3
    small = align_to_schema(spark.sql("SELECT 8417570425.82D AS rsi_14"), INDICATORS, float32=True)
    assert small.first()["rsi_14"] == 8417570304


def test_json_document(spark):
    records = spark.sql("SELECT map('Name', n) AS record FROM VALUES ('b'), ('a') AS t(n)")
    lines = exports.to_json_document(records, "src", datetime(2024, 1, 1)).orderBy("part", "json", "i")
    doc = json.loads("".join(r["line"] for r in lines.collect()))
    assert doc["scraping_info"]["total_companies"] == 2
    assert doc["companies"] == [{"Name": "a"}, {"Name": "b"}]


def bars_frame(spark, rows):
    cols = "date date, symbol string, open double, high double, low double, close double, ltp double, vol double"
    return align_to_schema(spark.createDataFrame(rows, cols), STOCK_BARS)


def stored(spark, path):
    return {(r["symbol"], r["date"]): r["ema_9"] for r in tables.read_table(spark, path, INDICATORS).collect()}


def test_backfill_daily_and_late_bar(spark, tmp_path):
    bars, out, again = (str(tmp_path / n) for n in ("bars", "indicators", "again"))
    rows = walk("A", 30, 1) + walk("B", 30, 2)
    late = rows.pop(10)
    tables.write_new_dates(bars_frame(spark, [r for r in rows if r[0] < date(2015, 1, 30)]), bars, STOCK_BARS)
    run_backfill(spark, bars, out)
    before = stored(spark, out)
    run_backfill(spark, bars, out)
    assert stored(spark, out) == before and len(before) == 57
    tables.write_new_dates(bars_frame(spark, [r for r in rows if r[0] == date(2015, 1, 30)]), bars, STOCK_BARS)
    for _ in range(2):
        run_daily(spark, bars, out, date(2015, 1, 30))
    assert len(stored(spark, out)) == 59
    run_daily(spark, bars, out, date(2016, 1, 1))
    # A bar that arrives late changes the later rows of its own series only.
    tables.write_upsert(bars_frame(spark, [late]), bars, STOCK_BARS)
    run_backfill(spark, bars, out)
    run_backfill(spark, bars, again)
    after = stored(spark, out)
    assert after == stored(spark, again) and len(after) == 60
    changed = {k for k in before if before[k] != after[k]}
    assert changed and all(s == late[1] and d > late[0] for s, d in changed)


def test_incomplete_dates(spark):
    rows = [(date(2024, 1, d), "A", None if d < 15 or d == 20 else 50.0) for d in range(1, 31)]
    done = spark.createDataFrame(rows, "date date, symbol string, rsi_14 double")
    assert G.incomplete_dates(done).count() == 15
    assert [r[0].day for r in G.incomplete_dates_after_warm_up(done).collect()] == [20]
    assert G.incomplete_dates(done.drop("rsi_14")).count() == 0


def test_ingest_today_needs_no_file(spark, tmp_path):
    write(tmp_path / "s", "2024-01-02.csv", HEADER, line("AAA", 10))
    paths = [str(tmp_path / n) for n in ("s", "stock")]
    ingest_today(spark, date(2024, 1, 2), *paths)
    ingest_today(spark, date(2024, 1, 3), *paths)
    assert tables.read_table(spark, paths[1], STOCK_BARS).count() == 1
    assert tables.read_table(spark, str(tmp_path / "none"), INDEX_BARS).count() == 0


def test_streams(spark, tmp_path):
    files, bars, out = (str(tmp_path / n) for n in ("files", "bars", "indicators"))
    for i, name in enumerate(("2024_01_02.csv", "2024_01_03.csv", "2024_01_03.csv")):
        write(tmp_path / "files", name, HEADER, line("AAA", 10 + i))
        stream_ingest(spark, files, bars, str(tmp_path / "c1")).awaitTermination()
        stream_indicators(spark, bars, out, str(tmp_path / "c2")).awaitTermination()
    # The second delivery of a date is skipped.
    assert stored(spark, out) == {("AAA", date(2024, 1, 2)): 10, ("AAA", date(2024, 1, 3)): pytest.approx(10.2)}


def test_wide_and_quoted_files(spark, tmp_path):
    d = tmp_path / "wide"
    wide = [f"c{i}" for i in range(60)]
    write(d, "a.csv", ",".join(wide), ",".join(["x"] * 59 + ["one"]))
    write(d, "b.csv", ",".join(wide), ",".join(["x"] * 59 + ["two"]))
    write(d, "c.csv", "Symbol,Close", "A,1")
    write(d, "d.csv", "Symbol,Close,,", "A,1,,")
    write(d, "e.csv", 'Symbol,Note', '"say ""hi"", x",7', '"two\nlines",8')
    cells = read_cells(spark, str(d))
    assert cells.selectExpr("max(size(cells)) AS n").first()["n"] == 60
    assert D.content_fingerprint(cells).select("fingerprint").distinct().count() == 5
    rows = {tuple(r["cells"]) for r in cells.where("file LIKE '%e.csv'").collect()}
    assert rows == {("Symbol", "Note"), ('say "hi", x', "7"), ("two\nlines", "8")}


def test_written_csv_reads_back(spark, tmp_path):
    import csv
    import datetime

    from barloom.sinks.exports import write_table_csv

    note = 'a "b", c'
    df = spark.createDataFrame([(datetime.date(2024, 1, 2), note, 1)], "date date, note string, n int")
    write_table_csv(df, str(tmp_path / "out"))
    (file,) = (tmp_path / "out").glob("*/*.csv")
    with open(file, newline="") as f:
        assert list(csv.reader(f)) == [["note", "n"], [note, "1"]]


def test_nested_tables_belong_to_the_outer_cells(spark):
    inner = "<table><tr><td>x</td></tr></table>"
    html = f"<table><tr><th>h</th></tr><tr><td>a</td><td>p{inner}</td><td> b </td></tr></table>"
    rows = extract_table(spark.createDataFrame([(1, html)], "page_id bigint, html string"))
    assert [r["cells"] for r in rows.orderBy("row_no").collect()] == [["h"], ["a", "px", "x", "b"], ["x"]]


def test_body_rows_with_a_head_cell(spark):
    html = (
        "<table><thead><tr><th>A</th><th>B</th></tr></thead>"
        "<tbody><tr><th>1</th><td>u</td><td>v</td></tr><tr><td>w</td><td>x</td></tr></tbody></table>"
    )
    pages = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    assert [r["cells"] for r in extract_tables_union(pages).orderBy("row_no").collect()] == [["u", "v"], ["w", "x"]]
    assert [r["record"] for r in extract_records(pages).orderBy("row_no").collect()] == [
        {"A": "u", "B": "v"}, {"A": "w", "B": "x"},
    ]


def test_probe_without_a_warm_up(spark):
    rows = [(date(2024, 1, d), "A", None if d == 2 else 1.0) for d in (1, 2, 3)]
    done = spark.createDataFrame(rows, "date date, symbol string, obv double")
    assert [r[0].day for r in G.incomplete_dates_after_warm_up(done, ("obv",)).collect()] == [2]


def test_backfill_converges(spark):
    close = [10.0 + d % 3 for d in range(30)]
    rows = [
        (date(2024, 1, d), s, close[d], close[d] + 1, close[d] - 1, close[d], close[d], 5.0) for d in range(1, 30) for s in "AB"
    ]
    bars = bars_frame(spark, rows)
    done = rows_to_backfill(bars, spark.createDataFrame([], INDICATORS))
    done = spark.createDataFrame(done.collect(), done.schema)
    assert done.count() == 58 and rows_to_backfill(bars, done).count() == 0
    some = done.where("NOT (symbol = 'B' AND date = DATE '2024-01-20')")
    fresh = rows_to_backfill(bars, some).select("symbol", "date").collect()
    assert {r["symbol"] for r in fresh} == {"B"} and sorted(r["date"].day for r in fresh) == list(range(20, 30))


def test_stream_batches_cut_through_a_date(spark, tmp_path):
    files, bars, checkpoint = (str(tmp_path / n) for n in ("files", "bars", "checkpoint"))
    (tmp_path / "files").mkdir()
    write(tmp_path / "files" / "b", "2024_01_02.csv", HEADER, line("AAA", 10), line("BBB", 11))
    write(tmp_path / "files" / "a", "2024_01_02.csv", HEADER, line("AAA", 20), line("CCC", 21))
    # The file whose name sorts last comes first.
    os.utime(tmp_path / "files" / "b" / "2024_01_02.csv", (1_700_000_000, 1_700_000_000))
    query = stream_ingest(spark, files, bars, checkpoint, files_per_batch=1)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 2

    def closes():
        return {r["symbol"]: r["close"] for r in tables.read_table(spark, bars, STOCK_BARS).collect()}

    assert closes() == {"AAA": 10, "BBB": 11, "CCC": 21}
    # A date that an earlier run loaded is skipped, and nothing stays staged.
    write(tmp_path / "files" / "c", "2024_01_02.csv", HEADER, line("DDD", 30))
    for _ in range(2):
        stream_ingest(spark, files, bars, checkpoint, files_per_batch=1).awaitTermination()
        assert closes() == {"AAA": 10, "BBB": 11, "CCC": 21}
    assert not list((tmp_path / "checkpoint" / "staged").rglob("*.parquet"))


def test_stream_run_that_failed_is_completed(spark, tmp_path, monkeypatch):
    files, bars, checkpoint = (str(tmp_path / n) for n in ("files", "bars", "checkpoint"))
    write(tmp_path / "files", "2024_01_02.csv", HEADER, line("AAA", 10))
    with monkeypatch.context() as m:
        m.setattr(jobs, "write_new_dates", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            stream_ingest(spark, files, bars, checkpoint)
    write(tmp_path / "files", "2024-01-02.csv", HEADER, line("BBB", 11))
    stream_ingest(spark, files, bars, checkpoint).awaitTermination()
    assert {r["symbol"] for r in tables.read_table(spark, bars, STOCK_BARS).collect()} == {"AAA", "BBB"}


def test_history_loads_all_parts_of_a_day(spark, tmp_path):
    d = tmp_path / "files"
    a, b, c = (line(s, i) for i, s in enumerate(("AAA", "BBB", "CCC"), 1))
    for folder in ("a/date=2024-01-02", "b/date=2024-01-02", "b/date=2024-01-03", "b/date=2024-01-04"):
        (d / folder).mkdir(parents=True)
    # The last delivery of the 2nd has two parts; the copy of it on the 3rd is cut otherwise.
    write(d / "a/date=2024-01-02", "part-00000-x.c000.csv", HEADER, line("OLD", 9))
    write(d / "b/date=2024-01-02", "part-00000-y.c000.csv", HEADER, a, b)
    write(d / "b/date=2024-01-02", "part-00001-y.c000.csv", HEADER, c)
    write(d / "b/date=2024-01-03", "part-00000-z.c000.csv", HEADER, a, b, c)
    # One part equals a part of the 2nd, but the day is no copy.
    write(d / "b/date=2024-01-04", "part-00000-y.c000.csv", HEADER, c)
    write(d / "b/date=2024-01-04", "part-00001-y.c000.csv", HEADER, line("DDD", 4))
    # Files named by their date stay deliveries of their own.
    write(d, "2024_01_05.csv", HEADER, line("EEE", 5))
    write(d, "2024-01-05.csv", HEADER, line("FFF", 6))

    def loaded(**options):
        path = str(tmp_path / f"t{len(options)}")
        ingest_history(spark, str(d), path, **options)
        return sorted((r["date"].day, r["symbol"]) for r in tables.read_table(spark, path, STOCK_BARS).collect())

    want = [(2, "AAA"), (2, "BBB"), (2, "CCC"), (4, "CCC"), (4, "DDD"), (5, "EEE")]
    assert loaded() == want
    assert loaded(skip_copies=False) == sorted(want + [(3, "AAA"), (3, "BBB"), (3, "CCC")])
