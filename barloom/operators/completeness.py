"""Which dates a table holds, which are incomplete and which still have to be computed.

Date sets have at most one entry per calendar day, so they are broadcast to the big side.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The measures whose absence makes a date incomplete.
PROBES = ("rsi_14", "stoch_k", "cci_20", "williams_r", "sma_200", "ema_9", "ema_200")
# First row (counted from 0) of a series at which each of them has a value.
WARM_UP = {
    "rsi_14": 14, "stoch_k": 13, "cci_20": 19, "williams_r": 13,
    "sma_200": 199, "ema_9": 0, "ema_200": 0,
}


def existing_dates(df: DataFrame) -> DataFrame:
    return df.select("date").distinct()


def rows_per_date(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"))


def series_profile(df: DataFrame, key: str = "symbol") -> DataFrame:
    """One row: the number of series and of dates.

    Two aggregates of their own instead of one with two distinct counts, which would copy
    every row once per count.
    """
    symbols = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(f"`{key}` IS NOT NULL")
    dates = df.groupBy("date").agg(F.count(F.lit(1)).alias("n")).where("date IS NOT NULL")
    counts = symbols.select(F.lit("s").alias("k")).unionAll(dates.select(F.lit("d").alias("k")))
    return counts.agg(
        F.count_if(F.col("k") == "s").alias("symbols"), F.count_if(F.col("k") == "d").alias("dates")
    )


def incomplete_dates(indicators: DataFrame, probes: tuple[str, ...] = PROBES) -> DataFrame:
    """Dates with a null in any probe column the table has; none if it has no probe column.

    Rows of a series' warm-up count as incomplete too, see ``incomplete_dates_after_warm_up``.
    """
    present = [p for p in probes if p in indicators.columns]
    if not present:
        return existing_dates(indicators).where("false")
    test = " OR ".join(f"`{p}` IS NULL" for p in present)
    return indicators.where(test).select("date").distinct()


def incomplete_dates_after_warm_up(
    indicators: DataFrame, probes: tuple[str, ...] = PROBES, key: str = "symbol"
) -> DataFrame:
    """As ``incomplete_dates``, but a null counts only after the measure's warm-up rows.

    A probe without an entry in ``WARM_UP`` has no warm-up: each of its nulls counts.

    The date on which a series leaves a warm-up is its n-th date. Only rows with a null are
    ranked against that date, which comes from the earliest rows of each series; the row
    limit per series is applied before the shuffle as well as after it.
    """
    present = [p for p in probes if p in indicators.columns]
    if not present:
        return existing_dates(indicators).where("false")
    warm_up = {p: WARM_UP.get(p, 0) for p in present}
    longest = max(warm_up.values()) + 1
    rank = F.row_number().over(Window.partitionBy(key).orderBy("date"))
    early = indicators.select(key, "date", rank.alias("_t")).where(F.col("_t") <= longest)
    ready = early.groupBy(key).agg(
        *[
            F.max(F.when(F.col("_t") == n + 1, F.col("date"))).alias(f"_ready_{n}")
            for n in sorted(set(warm_up.values()))
        ]
    )
    test = " OR ".join(f"(`{p}` IS NULL AND date >= _ready_{warm_up[p]})" for p in present)
    nulls = " OR ".join(f"`{p}` IS NULL" for p in present)
    gaps = indicators.where(nulls).select(key, "date", *present)
    return gaps.join(ready, key).where(test).select("date").distinct()


def dates_to_compute(bars: DataFrame, indicators: DataFrame, after_warm_up: bool = False) -> DataFrame:
    """Dates of the bars that have no indicators, and the incomplete dates."""
    probe = incomplete_dates_after_warm_up if after_warm_up else incomplete_dates
    missing = existing_dates(bars).join(F.broadcast(existing_dates(indicators)), "date", "left_anti")
    return missing.unionAll(probe(indicators)).distinct()


def restrict_to_dates(df: DataFrame, dates: DataFrame) -> DataFrame:
    return df.join(F.broadcast(dates.select("date").distinct()), "date", "left_semi")


def not_yet_loaded(files: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of ``files`` whose date the target does not hold."""
    return files.join(F.broadcast(existing_dates(target)), "date", "left_anti")


def newest_first_until(files: DataFrame, cutoff: date | None = date(2020, 1, 1)) -> DataFrame:
    """Newest date first, only dates after ``cutoff`` (all dates for None)."""
    if cutoff is not None:
        files = files.where(F.col("date") > F.lit(cutoff))
    return files.orderBy(F.col("date").desc(), *[c for c in files.columns if c != "date"])
