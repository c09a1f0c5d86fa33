"""Duplicate files and rows. All choices are aggregates, so a hot group is combined map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.clean import strip

_WORD = 8  # hex digits


def one_file_per_date(files: DataFrame, date: str = "date", name: str = "file") -> DataFrame:
    """Of several files for one date, the one whose name sorts last."""
    return files.where(F.col(date).isNotNull()).groupBy(date).agg(F.max(name).alias(name))


def content_fingerprint(
    rows: DataFrame, file: str = "file", cells: str = "cells", once: Column | None = None
) -> DataFrame:
    """MD5 per file over its trimmed rows, whatever their order: (file, n_rows, fingerprint).

    The MD5 of each row is cut into four numbers, and a file is the row count and the sums of
    those numbers. Sums do not depend on the order and combine map-side, so a huge file needs
    neither a sort nor a list of its rows. Rows marked by ``once``, such as the header that every
    part of a file repeats, count as one row per file.
    """
    trimmed = F.transform(cells, lambda c: strip(F.coalesce(c, F.lit(""))))
    # Every cell goes in with its length, so no text in a cell looks like a border between cells.
    sized = F.transform(trimmed, lambda c: F.concat(F.length(c).cast("string"), F.lit(":"), c))
    row = F.md5(F.array_join(sized, ""))
    hashed = rows.select(file, row.alias("h"), (F.lit(False) if once is None else once).alias("once"))

    def total(c: Column) -> Column:
        each = F.coalesce(F.sum(F.when(~F.col("once"), c)), F.lit(0))
        return each + F.coalesce(F.max(F.when(F.col("once"), c)), F.lit(0))

    words = [
        total(F.conv(F.substring("h", 1 + _WORD * i, _WORD), 16, 10).cast("decimal(20,0)")).alias(f"w{i}")
        for i in range(4)
    ]
    sums = hashed.groupBy(file).agg(total(F.lit(1).cast("bigint")).alias("n_rows"), *words)
    digest = F.md5(F.concat_ws(",", "n_rows", *[F.col(f"w{i}").cast("string") for i in range(4)]))
    return sums.select(file, "n_rows", digest.alias("fingerprint"))


def drop_duplicates_keep_first(files: DataFrame, file: str = "file") -> DataFrame:
    """One row per content: its fingerprint, the first file by name and the number of copies."""
    return files.groupBy("fingerprint").agg(
        F.min(file).alias("kept"), F.count(F.lit(1)).alias("copies")
    )


def find_duplicates(files: DataFrame, file: str = "file") -> DataFrame:
    """The files that repeat an earlier file's content: (file, kept, fingerprint).

    The join key may be one hot fingerprint; the other side has one row per fingerprint, and
    adaptive execution splits the hot partition of this side.
    """
    firsts = drop_duplicates_keep_first(files, file).where("copies > 1").drop("copies")
    return files.join(firsts, "fingerprint").where(F.col(file) != F.col("kept")).select(
        file, "kept", "fingerprint"
    )


def duplicate_summary(files: DataFrame, file: str = "file") -> DataFrame:
    """One row: files seen, duplicates among them, and files that remain."""
    contents = drop_duplicates_keep_first(files, file)
    return contents.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("files"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
        F.count(F.lit(1)).alias("remaining"),
    )


def dedupe_bars(df: DataFrame, order: str, keys: tuple[str, ...] = ("date", "symbol")) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (such as its file name).

    Rows equal in ``order`` are resolved by their remaining columns, so the result does not
    depend on how the input was partitioned.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.struct(F.col(order).alias("_o"), *rest)
    best = df.groupBy(*keys).agg(F.max(pick).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}") for c in df.columns])
