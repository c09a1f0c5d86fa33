"""Queries of the streaming jobs: two deliveries, the job run after each of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.catalog.bars import BARS_SQL
from barloom.catalog.indicators import ALL_SQL, DIGITS, _ewm
from barloom.catalog.registry import query, rounded, rounded_sql
from barloom.catalog.tables import _STOCK_OUT, _STOCK_SQL, _daily_stock, stock_cells
from barloom.operators.recurrence import span_alpha
from barloom.schema import INDICATOR_COLUMNS, INDICATORS, STOCK_BARS, align_to_schema
from barloom.session import new_folder, written
from barloom.sinks.exports import write_table_csv
from barloom.sinks.tables import read_table, write_new_dates
from barloom.sources.bars import stock_table
from barloom.streaming.jobs import STATE_STORE, stream_ewm, stream_indicators, stream_ingest

_HALVES = ("date < DATE '2024-01-16'", "date >= DATE '2024-01-16'")


def _halves(daily: DataFrame) -> list[DataFrame]:
    daily = written(daily, "stock")
    return [daily.where(half) for half in _HALVES]


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = {c: F.replace(c, F.lit(",")).cast("double") for c in ("vol", "turnover")}
    return stock_table(_daily_stock(spark, sf_dir).withColumns(number))


@query("stream_ingest", f"with {_STOCK_SQL.strip()} select {rounded_sql(_STOCK_OUT, 4)} from stock")
def stream_ingest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "stream-ingest")
    for part in _halves(_daily_stock(spark, sf_dir)):
        write_table_csv(part, f"{root}/files", stock_cells())
        stream_ingest(spark, f"{root}/files", f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return rounded(read_table(spark, f"{root}/table", STOCK_BARS), _STOCK_OUT, 4)


_W = "(partition by symbol order by date)"
_ALL_STREAM_SQL = ALL_SQL.replace(BARS_SQL.strip(), f"{_STOCK_SQL.strip()}, bars as (select * from stock)")
_STREAM_SQL = f"""with {_STOCK_SQL.strip()},
s as (select *, row_number() over {_W} - 1 as t from stock),
ind as (select *, {_ewm('close', '(2.0/10)', 't')} as ema_9 from s)"""


@query("stream_indicators", _ALL_STREAM_SQL)
def stream_indicators_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "stream-indicators")
    for part in _halves(_numbers(spark, sf_dir)):
        write_new_dates(part, f"{root}/bars", STOCK_BARS)
        stream_indicators(
            spark, f"{root}/bars", f"{root}/indicators", f"{root}/checkpoint"
        ).awaitTermination()
    return rounded(read_table(spark, f"{root}/indicators", INDICATORS), INDICATOR_COLUMNS, DIGITS)


@query("stream_indicators_late", _ALL_STREAM_SQL)
def stream_indicators_late_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table if bars of early days come with a third delivery, into folders that exist."""
    root = new_folder(spark, "stream-late")
    numbers = written(_numbers(spark, sf_dir), "stock")
    late = "crc32(encode(symbol, 'UTF-8')) % 3 = 0 AND day(date) % 5 = 2"
    for part in (f"NOT ({late}) AND {_HALVES[0]}", f"NOT ({late}) AND {_HALVES[1]}", late):
        rows = align_to_schema(numbers.where(part), STOCK_BARS)
        rows.write.mode("append").partitionBy("date").parquet(f"{root}/bars")
        stream_indicators(spark, f"{root}/bars", f"{root}/indicators", f"{root}/checkpoint").awaitTermination()
    return rounded(read_table(spark, f"{root}/indicators", INDICATORS), INDICATOR_COLUMNS, DIGITS)


def _ewm_stream(root: str, parts: list[DataFrame], delay_days: int | None = None) -> DataFrame:
    """Runs the stream anew for each part and gives all that it put out."""
    spark = parts[0].sparkSession
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    schema = "symbol string, date date, x double"
    for part in parts:
        part.write.mode("append").parquet(f"{root}/rows")
        stream = own.readStream.schema(schema).parquet(f"{root}/rows")
        (
            stream_ewm(stream, span_alpha(9), delay_days=delay_days)
            .writeStream.format("parquet")
            .option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    return spark.read.parquet(f"{root}/out").withColumnRenamed("ewm", "ema_9")


@query("stream_ewm", f"{_STREAM_SQL} select {rounded_sql(['ema_9'], 4)}, false as late from ind")
def stream_ewm_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each series is kept between the deliveries."""
    numbers = _numbers(spark, sf_dir).selectExpr("symbol", "date", "close AS x")
    out = _ewm_stream(new_folder(spark, "stream-ewm"), _halves(numbers))
    return rounded(out, ["ema_9"], 4, ["symbol", "late"])


@query(
    "stream_ewm_reordered",
    f"""{_STREAM_SQL} select {rounded_sql(['ema_9'], 4)}, false as late from ind
    where date <= (select max(date) - 3 from stock)
    union all select cast(date as varchar) as date, symbol, null as ema_9, true as late from ind
    where date = date '2024-01-02'""",
)
def stream_ewm_reordered_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries: even ones of the last days of the first half come with the second one and are in
    time; the third repeats an early day, too late to count. The newest days still wait."""
    numbers = written(_numbers(spark, sf_dir).selectExpr("symbol", "date", "close AS x"), "stock")
    days = [r[0] for r in numbers.select("date").distinct().orderBy("date").collect()]
    middle = days[len(days) // 2]
    held = (F.col("date") < F.lit(middle)) & (F.col("date") >= F.date_sub(F.lit(middle), 3)) & (F.day("date") % 2 == 0)
    first = numbers.where((F.col("date") < F.lit(middle)) & ~held)
    rest = numbers.where((F.col("date") >= F.lit(middle)) | held)
    again = numbers.where("date = DATE '2024-01-02'")
    out = _ewm_stream(new_folder(spark, "stream-reordered"), [first, rest, again], 3)
    return rounded(out, ["ema_9"], 4, ["symbol", "late"])
