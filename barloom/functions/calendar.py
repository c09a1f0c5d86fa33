"""Trading calendar: every day is open but those of the weekend."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Days of the week as numbered by dayofweek (Sunday is 1): Friday and Saturday are closed.
WEEKEND = (6, 7)


def is_weekend(day: Column, weekend: tuple[int, ...] = WEEKEND) -> Column:
    return F.dayofweek(day).isin(*weekend)


def latest_trading_day(day: Column, weekend: tuple[int, ...] = WEEKEND) -> Column:
    """The day itself or the last open day before it."""
    if not set(range(1, 8)) - set(weekend):
        raise ValueError("no open day in the week")
    back = F.coalesce(
        *[F.when(~is_weekend(F.date_sub(day, k), weekend), F.lit(k)) for k in range(7)]
    )
    return F.date_sub(day, back)


def open_days(bounds: DataFrame, start: str, end: str, weekend: tuple[int, ...] = WEEKEND) -> DataFrame:
    """Open days of the closed range in the columns ``start`` and ``end`` of each row."""
    days = bounds.where(F.col(start) <= F.col(end)).select(
        F.explode(F.sequence(start, end)).alias("date")
    )
    return days.where(~is_weekend(F.col("date"), weekend))


def trading_days(
    spark: SparkSession, start: date, end: date, desc: bool = False, weekend: tuple[int, ...] = WEEKEND
) -> DataFrame:
    """Open days from ``start`` to ``end``, oldest or newest first."""
    row = spark.range(1).select(F.lit(start).cast("date").alias("s"), F.lit(end).cast("date").alias("e"))
    days = open_days(row, "s", "e", weekend)
    return days.orderBy(F.col("date").desc() if desc else F.col("date"))


def missing_trading_days(
    df: DataFrame,
    start: date | None = None,
    end: date | None = None,
    column: str = "date",
    weekend: tuple[int, ...] = WEEKEND,
) -> DataFrame:
    """Open days without a row, from ``start`` (default: the first date) to ``end`` (the last)."""
    dates = df.select(F.col(column).cast("date").alias("date"))
    lo, hi = F.min("date"), F.max("date")
    bounds = dates.agg(
        (F.lit(start).cast("date") if start else lo).alias("s"),
        (F.lit(end).cast("date") if end else hi).alias("e"),
    )
    # Distinct days are bounded by the calendar, so they can be sent to every task.
    return open_days(bounds, "s", "e", weekend).join(
        F.broadcast(dates.where("date IS NOT NULL").distinct()), "date", "left_anti"
    )
