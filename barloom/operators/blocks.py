"""Split long ordered series into blocks that hold a bounded number of rows.

An ordered window over a whole series puts the series into one task. Here a series is
cut into blocks of about ``rows`` rows, and the last ``halo`` rows before a block are
copied into it, so that every look-back column of a block row is exact while no window
group is larger than a block. Series that fit into one block are left as they are.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.series import SeriesWindow
from barloom.session import shared_dir

BLOCK_ROWS = 4096
CELL_DAYS = 64
# A broadcast block table stays below about 16 MB: 24 bytes per block plus the symbol.
BROADCAST_BLOCKS = 250_000

BLOCK, HALO = "_blk", "_halo"


@dataclass(frozen=True)
class Blocked:
    """Rows with their block; ``split`` is false when every series is a single block.

    ``full`` holds the columns that were found to hold no null.
    """

    df: DataFrame
    key: str
    order: str
    split: bool
    full: frozenset[str] = frozenset()

    @property
    def window(self) -> SeriesWindow:
        keys = (self.key, BLOCK) if self.split else (self.key,)
        return SeriesWindow(keys, self.order)

    def live(self, sql: str) -> str:
        """``sql`` on the rows that belong to the block, null on copied rows."""
        return f"CASE WHEN NOT {HALO} THEN {sql} END" if self.split else f"({sql})"


def _cell(order: str) -> Column:
    return F.floor(F.unix_date(order) / CELL_DAYS)


def block_bounds(df: DataFrame, rows: int, halo: int, key: str, order: str) -> DataFrame:
    """One row per series of more than one block: its blocks as (lo, hi, from, blk) cells.

    A cell is a run of ``CELL_DAYS`` calendar days. ``[lo, hi)`` are the block's own cells
    and ``[from, lo)`` hold at least ``halo`` earlier rows, or all there are. Rows are only
    counted per cell (with partial aggregation), so the ordered part runs over at most one
    entry per 64 calendar days of a series, a bound set by the calendar.
    """
    cells = df.groupBy(key, _cell(order).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    by_cell = Window.partitionBy(key).orderBy("cell")
    by_start = Window.partitionBy(key).orderBy("start")
    running = by_cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cells.withColumn("start", F.sum("n").over(running) - F.col("n"))
    placed = placed.withColumn(BLOCK, F.floor(F.col("start") / rows))
    placed = placed.select(
        key,
        BLOCK,
        "cell",
        F.max("cell").over(by_start.rangeBetween(Window.unboundedPreceding, -halo)).alias("from"),
        (F.coalesce(F.lag(BLOCK).over(by_start), F.lit(-1)) != F.col(BLOCK)).alias("opens"),
    )
    blocks = placed.where("opens").select(
        key,
        F.struct(
            F.col("cell").alias("lo"),
            F.lead("cell").over(by_cell).alias("hi"),
            # No cell lies far enough back: the copied rows start with the series.
            F.coalesce("from", F.lit(-(2**31))).alias("from"),
            F.col(BLOCK).alias("blk"),
        ).alias("b"),
    )
    return (
        blocks.groupBy(key)
        .agg(F.sort_array(F.collect_list("b")).alias("_blocks"))
        .where(F.size("_blocks") > 1)
    )


def split_series(
    df: DataFrame,
    halo: int,
    rows: int = BLOCK_ROWS,
    key: str = "symbol",
    order: str = "date",
    look_for_nulls: Collection[str] = (),
) -> Blocked:
    """Assign blocks to a table that is unique on (key, order), ``order`` being a date.

    The count of rows also tells which columns of ``look_for_nulls`` hold no null.

    The sizes are computed first (a scan of one or two columns) because they decide the
    plan: no series above ``rows`` means no split at all, a block table of proven small size
    is broadcast, and any other is joined with a shuffle, where adaptive execution splits a
    hot series.
    """
    if rows < halo + 2 * CELL_DAYS:
        raise ValueError("a block must be longer than its halo")
    # Said once here, it is the same filter in every branch that reads the blocks, and the
    # branches can share one shuffle.
    # A row without a date has no place in a series, whether the series is split or not.
    df = df.where(F.col(key).isNotNull() & F.col(order).isNotNull())
    columns = [c for c in look_for_nulls if c in df.columns]
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"_n_{c}") for c in columns])
    sizes = counts.agg(F.max("n"), *[F.sum(F.col("n") - F.col(f"_n_{c}")) for c in columns]).first()
    longest, full = sizes[0], frozenset(c for c, nulls in zip(columns, sizes[1:]) if not nulls)
    if (longest or 0) <= rows:
        return Blocked(df, key, order, False, full)
    shared_dir(df.sparkSession)
    bounds = block_bounds(df, rows, halo, key, order).checkpoint()
    entries = bounds.agg(F.sum(F.size("_blocks"))).first()[0]
    if not entries:
        return Blocked(df, key, order, False, full)
    if entries <= BROADCAST_BLOCKS:
        bounds = F.broadcast(bounds)
    cell = _cell(order)
    single = F.array(F.struct(F.lit(0).cast("bigint").alias("blk"), F.lit(False).alias("halo")))
    own = F.transform(
        F.filter(
            "_blocks",
            lambda b: (cell >= b["from"]) & (b["hi"].isNull() | (cell < b["hi"])),
        ),
        lambda b: F.struct(b["blk"].alias("blk"), (cell < b["lo"]).alias("halo")),
    )
    marked = (
        df.join(bounds, key, "left")
        .withColumn("_at", F.explode(F.coalesce(own, single)))
        .withColumns({BLOCK: F.col("_at.blk"), HALO: F.col("_at.halo")})
        .drop("_blocks", "_at")
    )
    return Blocked(marked, key, order, True, full)
