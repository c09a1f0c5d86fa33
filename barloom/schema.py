"""Fixed table schemas and additive alignment to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The header of a daily stock file and the column each cell is stored in.
STOCK_HEADERS = {
    "Symbol": "symbol",
    "Conf.": "conf",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "LTP": "ltp",
    "Close - LTP": "close_minus_ltp",
    "Close - LTP %": "close_minus_ltp_pct",
    "VWAP": "vwap",
    "Vol": "vol",
    "Prev. Close": "prev_close",
    "Turnover": "turnover",
    "Trans.": "trans",
    "Diff": "diff",
    "Range": "range",
    "Diff %": "diff_pct",
    "Range %": "range_pct",
    "VWAP %": "vwap_pct",
    "52 Weeks High": "weeks_52_high",
    "52 Weeks Low": "weeks_52_low",
}

# The header of a daily index file, either spelling.
INDEX_HEADERS = {
    "Index": "index",
    "Current": "current",
    "Point Change": "point_change",
    "% Change": "pct_change",
    "Turnover": "turnover",
}

# The measures of the indicator table, in table order.
INDICATOR_COLUMNS = """
    rsi_14 macd_line macd_signal macd_hist stoch_k stoch_d cci_20 williams_r momentum_5
    sma_5 sma_10 sma_20 sma_50 sma_200 ema_9 ema_12 ema_26 ema_200
    adx_14 plus_di minus_di slope_20 acceleration
    atr_14 bb_upper bb_lower ichimoku_conversion ichimoku_base ichimoku_span_a ichimoku_span_b
    chandelier_long chandelier_short obv mfi_14 kvo
""".split()

KEYS = ("date", "symbol")


def _table(name: str, measures: list[str]) -> T.StructType:
    fields = [T.StructField("date", T.DateType()), T.StructField(name, T.StringType())]
    return T.StructType(fields + [T.StructField(m, T.DoubleType()) for m in measures])


STOCK_BARS = _table("symbol", [c for c in STOCK_HEADERS.values() if c != "symbol"])
INDEX_BARS = _table("index", [c for c in INDEX_HEADERS.values() if c != "index"])
INDICATORS = _table("symbol", INDICATOR_COLUMNS)


def align_to_schema(df: DataFrame, schema: T.StructType, float32: bool = False) -> DataFrame:
    """The columns of ``schema`` in its order: missing ones as typed nulls, others dropped.

    ``float32`` rounds every double measure to four bytes, as a REAL column would store it.
    """
    have = set(df.columns)

    def column(f: T.StructField):
        c = F.col(f"`{f.name}`") if f.name in have else F.lit(None)
        if float32 and isinstance(f.dataType, T.DoubleType):
            c = c.cast("float")
        return c.cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema.fields])
