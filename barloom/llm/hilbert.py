"""Sharding along a Hilbert curve over quantised metadata (operator 2), in DataFrame operations only.

Every dimension is cut into 2^bits cells at its quantiles; the cells' place on the Hilbert curve
orders the rows, and runs of equal row counts become shards. Neighbours on the curve are
neighbours in every dimension, so each shard spans a small range of each of them and a reader
prunes files on any dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from barloom.llm.expressions import let
from barloom.session import written

#: Rows of a slice: the part of a curve cell that one task numbers.
SLICE_ROWS = 1_000_000
#: A slice has no more than this share of all rows, so that small inputs spread as well.
SLICES = 1024


def _measure(df: DataFrame, name: str) -> Column:
    """What a column is ordered by: its number, or its whole text."""
    number = isinstance(df.schema[name].dataType, NumericType)
    return F.col(name).cast("double" if number else "string")


def _cell(measure: Column, cuts: Sequence[float | str]) -> Column:
    """0 for null and everything up to the first cut, then one more for every cut below the value."""

    def count(value: Column) -> Column:
        return sum([F.when(value > F.lit(c), 1).otherwise(0) for c in cuts], F.lit(0)).cast("int")

    return let(measure, count)


def hilbert_index(cells: Sequence[Column], bits: int) -> Column:
    """The Hilbert index of integer cells (each below 2^bits) as a long.

    Walks the bits from the highest: each step flips or swaps the lower bits of the first axis and
    another, then the axes are Gray-coded and their bits interleaved.
    """
    n = len(cells)
    steps = F.array(*[F.lit(b * n + i) for b in range(bits - 1, 0, -1) for i in range(n)])

    def turned(axes: Column, step: Column) -> Column:
        high = F.call_function("shiftleft", F.lit(1), F.floor(step / n).cast("int"))
        axis, low = F.get(axes, step % n), high - 1

        def moved(swap: Column) -> Column:
            own = lambda v, i: F.when(i == step % n, v.bitwiseXOR(swap)).otherwise(v)
            return F.transform(F.transform(axes, own), lambda v, i: F.when(i == 0, v.bitwiseXOR(swap)).otherwise(v))

        flipped = F.transform(axes, lambda v, i: F.when(i == 0, v.bitwiseXOR(low)).otherwise(v))
        swap = F.get(axes, F.lit(0)).bitwiseXOR(axis).bitwiseAND(low)
        return F.when(axis.bitwiseAND(high) != 0, flipped).otherwise(let(swap, moved))

    def interleaved(axes: Column) -> Column:
        gray, parts = F.lit(0), []
        for i in range(n):
            gray = gray.bitwiseXOR(F.get(axes, F.lit(i)))
            parts.append(gray)
        turn = F.lit(0)
        for b in range(bits - 1, 0, -1):
            turn = turn.bitwiseXOR(F.when(parts[-1].bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)))
        coded = F.array(*[p.bitwiseXOR(turn) for p in parts])

        def mixed(codes: Column) -> Column:
            index = F.lit(0).cast("long")
            for b in range(bits):
                for i in range(n):
                    bit = F.shiftright(F.get(codes, F.lit(i)), b).bitwiseAND(F.lit(1)).cast("long")
                    index = index + bit * F.lit(1 << (b * n + n - 1 - i))
            return index

        return let(coded, mixed)

    start = F.array(*[c.cast("int") for c in cells])
    return let(F.aggregate(steps, start, turned), interleaved)


def _text_cuts(df: DataFrame, texts: Sequence[str], bits: int) -> dict[str, list[str]]:
    """The values at the ranks m * i / 2^bits of each text dimension's m values, counted over all rows.

    Distinct values are counted, sorted by ranges and numbered within their range; the driver
    gets a count per range and the values at the ranks, no others.
    """
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), _measure(df, d).alias("value")) for i, d in enumerate(texts)]))
    counted = df.select(each.alias("e")).select("e.*").where("value IS NOT NULL").groupBy("dim", "value").agg(F.count(F.lit(1)).alias("n"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(counted.repartitionByRange(parts, "dim", "value").withColumn("part", F.spark_partition_id()), "text-ranges")
    sums = ranged.groupBy("dim", "part").agg(F.sum("n")).orderBy("dim", "part").collect()
    wanted = []
    for i in range(len(texts)):
        total, before = sum(n for dim, _, n in sums if dim == i), 0
        ranks = [total * k // (1 << bits) for k in range(1, 1 << bits)] if total else []
        for _, part, n in (r for r in sums if r[0] == i):
            wanted += [(i, part, r - before) for r in ranks if before <= r < before + n]
            before += n
    if not wanted:
        return {d: [] for d in texts}
    along = Window.partitionBy("dim", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    holds = F.lit(False)
    for dim, part in sorted({w[:2] for w in wanted}):
        holds |= (F.col("dim") == dim) & (F.col("part") == part)
    # Ranks are relative to the range here.
    placed = ranged.where(holds).withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0)))
    rank = F.explode(F.array(*[F.struct(*[F.lit(x).cast("long").alias(c) for c, x in zip(("d", "p", "r"), w)]) for w in wanted]))
    here = "dim = d AND part = p AND before <= r AND r < before + n"
    found = placed.select("*", rank.alias("w")).select("dim", "part", "before", "n", "value", "w.*").where(here).select("d", "p", "r", "value")
    at = {(d, p, r): value for d, p, r, value in found.collect()}
    return {d: [at[w] for w in wanted if w[0] == i] for i, d in enumerate(texts)}


def quantile_cuts(df: DataFrame, dims: Sequence[str], bits: int) -> list[list[float] | list[str]]:
    """2^bits - 1 cut points per dimension; all null: none. All rows count.

    Those of numbers come from mergeable quantile sketches, those of texts are exact and whole. Cuts
    only set how evenly the cells of the curve are filled.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = [d for d in dims if isinstance(df.schema[d].dataType, NumericType)]
    texts = [d for d in dims if d not in numbers]
    cuts: dict[str, list] = {}
    if numbers:
        sketches = [F.percentile_approx(_measure(df, d), shares, 10_000).alias(f"c{i}") for i, d in enumerate(numbers)]
        cuts |= {d: [float(c) for c in row or []] for d, row in zip(numbers, df.agg(*sketches).first())}
    if texts:
        cuts |= _text_cuts(df, texts, bits)
    return [cuts[d] for d in dims]


def shard_ranges(placed: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Per shard the least and greatest value of every dimension: what a reader prunes files by.

    Columns: shard, n_rows, and min_<dim>, max_<dim>; nulls are left out. Combined before the shuffle.
    """
    ends = [f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)]
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), *ends)


def hilbert_shards(
    df: DataFrame,
    key: str,
    dims: Sequence[str],
    shards: int,
    bits: int = 4,
    cuts: Sequence[Sequence[float | str]] | None = None,
) -> DataFrame:
    """All columns of ``df`` and ``curve`` (place on the curve), ``shard`` and ``slot``.

    Shard sizes differ by one row at most; ``slot`` counts from 0 in each shard, along the curve.
    Rows of one curve cell follow a hash of ``key``, then ``key`` itself.

    Nulls: a null dimension lies in the lowest cell; null keys come first within their hash.
    Ties and repeated rows: rows equal in curve and key share a slice and take neighbouring slots.
    Empty table: no rows. Columns of ``df`` named like a result or starting with ``_hilbert`` are
    replaced or refused: pass them renamed.

    Scale: the cells are at most 2^(bits * dims) rows, the slices at most that plus
    max(SLICES, rows / SLICE_ROWS); only these bounded tables are numbered in one task and
    broadcast. A cell that holds a third of all rows is cut into slices by the hash, so each
    row crosses one shuffle and no task numbers more than a slice.
    """
    clash = [c for c in df.columns if c.startswith("_hilbert")]
    if clash:
        raise ValueError(f"reserved column names: {clash}")
    df = df.drop("curve", "shard", "slot")
    cuts = cuts if cuts is not None else quantile_cuts(df, dims, bits)
    cells = [_cell(_measure(df, d), cut) for d, cut in zip(dims, cuts)]
    placed = df.withColumn("curve", hilbert_index(cells, bits))
    placed = placed.withColumn("_hilbert_hash", F.xxhash64(F.col(key), F.lit(41)))

    per_cell = placed.groupBy("curve").agg(F.count(F.lit(1)).alias("_hilbert_rows"))
    whole = Window.partitionBy()
    target = F.greatest(
        F.least(F.ceil(F.sum("_hilbert_rows").over(whole) / SLICES), F.lit(SLICE_ROWS)), F.lit(1)
    )
    per_cell = per_cell.select(
        "curve", F.ceil(F.col("_hilbert_rows") / target).cast("long").alias("_hilbert_slices")
    )
    sliced = placed.join(F.broadcast(per_cell), "curve").withColumn(
        "_hilbert_slice", F.pmod(F.col("_hilbert_hash"), F.col("_hilbert_slices"))
    )
    along = Window.orderBy("curve", "_hilbert_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        sliced.groupBy("curve", "_hilbert_slice")
        .agg(F.count(F.lit(1)).alias("_hilbert_n"))
        .select(
            "curve",
            "_hilbert_slice",
            F.coalesce(F.sum("_hilbert_n").over(along), F.lit(0)).alias("_hilbert_before"),
            F.sum("_hilbert_n").over(whole).alias("_hilbert_all"),
        )
    )
    within = Window.partitionBy("curve", "_hilbert_slice").orderBy("_hilbert_hash", key)
    ranked = sliced.withColumn("_hilbert_rank", F.row_number().over(within) - 1).join(
        F.broadcast(before), ["curve", "_hilbert_slice"]
    )
    place = F.col("_hilbert_before") + F.col("_hilbert_rank")
    shard = F.expr(f"((_hilbert_before + _hilbert_rank) * {int(shards)}) div _hilbert_all")
    return (
        ranked.withColumn("shard", shard.cast("int"))
        # The first place of a shard is the least one whose product reaches the shard's number.
        .withColumn("slot", (place - F.expr(f"(shard * _hilbert_all + {int(shards) - 1}) div {int(shards)}")).cast("long"))
        .select(*df.columns, "curve", "shard", "slot")
    )
