"""The registered queries: a Spark job over the given tables and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


Digits = int | Mapping[str, int]


def _digits(digits: Digits, column: str) -> int:
    return digits if isinstance(digits, int) else digits[column]


def rounded(df: DataFrame, columns: Sequence[str], digits: Digits, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Date as text, keys, and measures rounded for comparison (adding 0 turns -0.0 into 0.0)."""
    return df.select(
        F.col("date").cast("string").alias("date"),
        *keys,
        *[(F.round(c, _digits(digits, c)) + F.lit(0.0)).alias(c) for c in columns],
    )


def rounded_sql(columns: Sequence[str], digits: Digits, keys: Sequence[str] = ("symbol",)) -> str:
    cols = ", ".join(f"round({c}, {_digits(digits, c)}) + 0.0 as {c}" for c in columns)
    return f"cast(date as varchar) as date, {', '.join(keys)}, {cols}"
