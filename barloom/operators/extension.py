"""Extension point for user-written functions over one series."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TypeVar

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.blocks import BLOCK, BLOCK_ROWS, HALO, split_series


def apply_per_series(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    key: str = "symbol",
    order: str = "date",
    lookback: int | None = None,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Apply ``fn`` to the pandas frame of every series, its rows in order.

    For functions that no column expression can state. With ``lookback``, the number of earlier
    rows that a row's result depends on, ``fn`` returns one row per row it gets: a long series is
    then handed over in blocks of about ``rows`` rows, each after that many earlier rows, and no
    task holds more. Such a table is unique on (key, order), a date. Without it ``fn`` may return
    any rows, and a series goes to it whole; a function of unknown reach that can go through its series
    once, with a state, is better given to ``fold_per_series``.
    """
    if lookback is None:
        return df.groupBy(key).applyInPandas(lambda pdf: fn(pdf.sort_values(order, ignore_index=True)), schema)
    blocked = split_series(df, lookback, rows, key, order)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, ignore_index=True)
        if HALO not in pdf:
            return fn(pdf)
        own = ~pdf[HALO].to_numpy()
        return fn(pdf.drop(columns=[BLOCK, HALO]))[own]

    return blocked.df.groupBy(*blocked.window.keys).applyInPandas(one, schema)


State = TypeVar("State")


def fold_per_series(
    df: DataFrame,
    start: Callable[[], State],
    fn: Callable[[State, pd.DataFrame], tuple[State, pd.DataFrame | None]],
    schema: T.StructType | str,
    key: str = "symbol",
    order: str = "date",
    end: Callable[[State], pd.DataFrame | None] | None = None,
) -> DataFrame:
    """Carry a state through the rows of every series, in order.

    For functions of unknown reach over series of any length. A series comes as consecutive pandas frames;
    ``fn(state, frame)`` gives the state behind the frame and any rows, ``start()`` the state before the
    first frame, and ``end(state)`` rows behind the last one. How a series is cut into frames is not
    defined, so the rows must not depend on it.

    A task holds one frame (of at most ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows) and one
    state; Spark sorts, and spills what it cannot hold. Rows without a key are a series of their
    own, those without an order come first, and rows equal in it are ordered by their other columns.
    A series is one task's work from its first row to its last.
    """
    ties = [f.name for f in df.schema if f.name not in (key, order) and not isinstance(f.dataType, T.MapType)]
    rows = df.repartition(F.col(key)).sortWithinPartitions(key, order, *ties)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, now, begun = None, None, False
        for batch in batches:
            names = batch[key]
            # Equal neighbours are one piece; a null equals a null.
            new = (names != names.shift()) & ~(names.isna() & names.shift().isna())
            if len(batch):
                new.iloc[0] = True
            cuts = [*new.to_numpy().nonzero()[0].tolist(), len(batch)]
            for a, b in zip(cuts, cuts[1:]):
                piece = batch.iloc[a:b].reset_index(drop=True)
                name = None if pd.isna(names.iloc[a]) else names.iloc[a]
                if not begun or name != now:
                    if begun and end is not None:
                        yield from _rows(end(state))
                    state, now, begun = start(), name, True
                state, out = fn(state, piece)
                yield from _rows(out)
        if begun and end is not None:
            yield from _rows(end(state))

    return rows.mapInPandas(fold, schema)


def _rows(out: pd.DataFrame | None) -> Iterator[pd.DataFrame]:
    if out is not None and len(out):
        yield out
