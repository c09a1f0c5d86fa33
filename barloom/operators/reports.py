"""Ranked period reports over daily bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Metric name -> expression over the rows of one symbol and period.
METRICS = {
    "turnover": "sum(turnover)",
    "shares_traded": "sum(vol)",
    "transactions": "sum(trans)",
}


def fiscal_year(day: Column, first_month: int = 7, first_day: int = 16) -> Column:
    """Calendar year in which the fiscal year of ``day`` starts."""
    starts = (F.month(day) > first_month) | (
        (F.month(day) == first_month) & (F.dayofmonth(day) >= first_day)
    )
    return F.year(day) - F.when(starts, 0).otherwise(1)


def top_k_report(
    bars: DataFrame,
    metric: str = "turnover",
    k: int = 10,
    period: Column | None = None,
    shares: DataFrame | None = None,
) -> DataFrame:
    """The ``k`` symbols with the largest metric, overall or within each ``period``.

    Sums are combined before the shuffle, and the per-period ranking keeps k rows per task
    before it shuffles them. ``market_cap`` is the last close of the period times the
    ``shares`` outstanding (symbol, shares_outstanding), which bars do not hold.
    """
    keys = ["symbol"] if period is None else ["period", "symbol"]
    if period is not None:
        bars = bars.withColumn("period", period)
    if metric == "market_cap":
        if shares is None:
            raise ValueError("market_cap needs the shares outstanding")
        last = bars.groupBy(*keys).agg(F.max_by("close", F.unix_date("date")).alias("close"))
        sums = last.join(shares, "symbol").select(
            *keys, (F.col("close") * F.col("shares_outstanding")).alias("value")
        )
    else:
        sums = bars.groupBy(*keys).agg(F.expr(METRICS[metric]).alias("value"))
    order = [F.col("value").desc(), F.col("symbol")]
    if period is None:
        ranked = sums.orderBy(*order).limit(k)
        # At most k rows are left for this window.
        return ranked.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    rank = F.row_number().over(Window.partitionBy("period").orderBy(*order))
    return sums.withColumn("rank", rank).where(F.col("rank") <= k)
