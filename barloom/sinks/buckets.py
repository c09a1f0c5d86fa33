"""Bar and indicator tables stored by series: bucketed by symbol, so that work per series needs no shuffle.

The files of a bucket hold whole series. Windows over a series, joins of two such tables and upserts
into one read each bucket in one task. Years are folders, so that an upsert rewrites only its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.schema import KEYS
from barloom.session import written

_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def by_series(spark: SparkSession) -> Iterator[None]:
    """While this holds, joins on (date, symbol) use tables that are dealt by symbol as they are."""
    before = spark.conf.get(_ALL_KEYS)
    spark.conf.set(_ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(_ALL_KEYS, before)


def _rows(df: DataFrame, buckets: int) -> DataFrame:
    # One task writes a bucket, so that each folder has one file of it.
    return df.withColumn("year", F.year("date")).repartition(buckets, "symbol").sortWithinPartitions("year", "symbol", "date")


def create_series_table(df: DataFrame, table: str, path: str, buckets: int = 64) -> None:
    """Store ``df`` (with date and symbol) as the new catalog table ``table`` with its files at ``path``.

    Use as many buckets as the cluster has tasks at a time, and the same number for tables that are joined.
    The column ``year`` is added. Rows without a date go to a folder of their own.
    """
    if "year" in df.columns:
        raise ValueError("the table's folders are named by year")
    writer = _rows(df, buckets).write.partitionBy("year").bucketBy(buckets, "symbol").sortBy("symbol", "date")
    writer.option("path", path).saveAsTable(table)


def read_series_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop("year")


def upsert_series(new: DataFrame, target: DataFrame) -> DataFrame:
    """``target`` with the rows of ``new`` inserted, or put in place of rows with their key.

    For a target read from a table by series, within ``by_series``: only ``new`` is shuffled. ``new``
    holds each key once; columns that it lacks are null.
    """
    kept = target.join(new.select(*KEYS), list(KEYS), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def write_upsert_series(new: DataFrame, table: str) -> None:
    """Upsert into a table by series. Only the folders of the years in ``new`` are read and rewritten.

    ``new`` is computed once and written first. Readers see the old files or the new ones of a folder.
    """
    spark = new.sparkSession
    new = written(new, "upsert")
    years = [r[0] for r in new.select(F.year("date").alias("y")).distinct().collect()]
    if not years:
        return
    target = spark.table(table)
    columns = target.columns
    buckets = int(spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").first()["data_type"])
    known = F.col("year").isin([y for y in years if y is not None])
    touched = target.where(known | F.col("year").isNull() if None in years else known).drop("year")
    with by_series(spark):
        rows = _rows(upsert_series(new, touched), buckets).select(*columns)
        before = spark.conf.get(_OVERWRITE)
        spark.conf.set(_OVERWRITE, "dynamic")
        try:
            rows.write.mode("overwrite").insertInto(table)
        finally:
            spark.conf.set(_OVERWRITE, before)
