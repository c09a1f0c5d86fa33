"""Parquet tables partitioned by date: append, upsert, schema growth."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.completeness import PROBES, existing_dates, not_yet_loaded, restrict_to_dates, rows_per_date
from barloom.schema import KEYS, align_to_schema
from barloom.session import written


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` in ``schema``: columns its older files lack are null, and a table
    that does not exist yet is empty."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


_V1_SOURCES = "spark.sql.sources.useV1SourceList"


def stored_counts(
    spark: SparkSession, path: str, schema: T.StructType, columns: tuple[str, ...] = ()
) -> DataFrame:
    """Per date of the table at ``path``: ``n_rows``, and ``n_<column>``, the rows with a value in it.

    The counts come from the footers of the files (aggregates pushed down to the Parquet source); no
    column is read. A table that does not exist has no dates.
    """
    before = spark.conf.get(_V1_SOURCES)
    kept = ",".join(s for s in before.split(",") if s.strip().lower() != "parquet")
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set(_V1_SOURCES, kept)
    try:
        rows = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    finally:
        spark.conf.set(_V1_SOURCES, before)
    return rows.groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"n_{c}") for c in columns])


def stored_incomplete_dates(
    spark: SparkSession, path: str, schema: T.StructType, probes: tuple[str, ...] = PROBES
) -> DataFrame:
    """``incomplete_dates`` of a stored table, from its footers."""
    present = tuple(p for p in probes if p in schema.fieldNames())
    counts = stored_counts(spark, path, schema, present)
    short = [f"`n_{p}` < n_rows" for p in present] or ["false"]
    return counts.where(" OR ".join(short)).select("date")


def _write(df: DataFrame, path: str, mode: str) -> None:
    # Rebalancing groups rows by date, so that a day becomes few files, and splits a large day.
    (
        df.hint("rebalance", "date")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def append_new_dates(new: DataFrame, target: DataFrame) -> DataFrame:
    """The rows of ``new`` to append: a date that the target holds is skipped as a whole."""
    return not_yet_loaded(new, target).select(*new.columns)


def write_new_dates(new: DataFrame, path: str, schema: T.StructType) -> None:
    target = read_table(new.sparkSession, path, schema)
    _write(append_new_dates(align_to_schema(new, schema), target), path, "append")


def skip_if_same_count(new: DataFrame, target: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The table after loading ``new``, where a date is skipped if the counts agree.

    A date with another count is loaded as a whole. Rows whose key the target has replace
    the old ones instead of being stored twice.
    """
    counts = rows_per_date(new).join(
        F.broadcast(rows_per_date(target).withColumnRenamed("n_rows", "loaded")), "date", "left"
    )
    changed = counts.where("loaded IS NULL OR loaded <> n_rows").select("date")
    return upsert(restrict_to_dates(new, changed), target, keys)


def upsert(new: DataFrame, target: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``target`` with the rows of ``new`` inserted, or put in place of rows with their key.

    ``new`` holds each key once. Columns that either side lacks are null.
    """
    kept = target.join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def write_upsert(
    new: DataFrame, path: str, schema: T.StructType, keys: tuple[str, ...] = KEYS, stored: bool = False
) -> None:
    """Upsert into the table at ``path``. Only partitions of dates in ``new`` are read and rewritten.

    ``new`` is needed for the dates, the keys and the rows; it is computed once and written first,
    unless it is ``stored`` already.
    """
    new = new if stored else written(new, "upsert")
    target = read_table(new.sparkSession, path, schema)
    touched = target.join(F.broadcast(existing_dates(new)), "date", "left_semi")
    _write(upsert(align_to_schema(new, schema), touched, keys).select(*schema.fieldNames()), path, "overwrite")
