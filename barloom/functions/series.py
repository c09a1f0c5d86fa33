"""Column builders over one ordered series, as Spark SQL expressions.

Every frame of a ``SeriesWindow`` shares one ``PARTITION BY``/``ORDER BY`` pair, so any
number of rolling columns costs one shuffle and one sort. Expressions are SQL text because
a wide plan of several hundred small columns is then sent to the driver JVM in a few calls.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

TYPICAL_PRICE = "(high + low + close) / 3"
# greatest() skips nulls, so the first row of a series is its high minus its low.
TRUE_RANGE = "greatest(high - low, abs(high - {prev}), abs(low - {prev}))"


def true_range(prev_close: str) -> str:
    return TRUE_RANGE.format(prev=prev_close)


def ratio(num: str, den: str) -> str:
    """Division that yields null for a zero denominator."""
    return f"(({num}) / nullif({den}, 0))"


def add_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``df`` plus the named SQL expressions it does not have yet, in one projection."""
    have = set(df.columns)
    new = [f"{sql} AS `{name}`" for name, sql in columns.items() if name not in have]
    return df.selectExpr("*", *new) if new else df


@dataclass(frozen=True)
class SeriesWindow:
    """Frames over rows of one series (or of one block of it) in date order."""

    keys: tuple[str, ...] = ("symbol",)
    order: str = "date"

    def over(self, frame: str = "") -> str:
        keys = ", ".join(f"`{k}`" for k in self.keys)
        return f"OVER (PARTITION BY {keys} ORDER BY `{self.order}` {frame})"

    @property
    def running(self) -> str:
        return self.over("ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")

    @property
    def before(self) -> str:
        return self.over("ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")

    def lag(self, sql: str, n: int = 1) -> str:
        return f"lag({sql}, {n}) {self.over()}"

    # A frame of n rows counts only when it has n rows and none of its values is null. Both
    # follow from the date n-1 rows back and the date of the latest null so far.

    def marks(self, column: str, *sizes: int, nullable: bool = True) -> dict[str, str]:
        """Helper columns that ``full`` needs for frames of ``column``."""
        marks = {f"_from_{n}": self.lag(f"`{self.order}`", n - 1) for n in sizes}
        if nullable:
            marks[f"_null_{column}"] = (
                f"max(CASE WHEN `{column}` IS NULL THEN `{self.order}` END) {self.running}"
            )
        return marks


def full(value: str, column: str, n: int, nullable: bool = True) -> str:
    """``value`` where the last n rows exist and hold no null ``column``, else null."""
    test = f"_from_{n} IS NOT NULL"
    if nullable:
        test += f" AND (_null_{column} IS NULL OR _null_{column} < _from_{n})"
    return f"CASE WHEN {test} THEN {value} END"
