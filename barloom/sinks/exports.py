"""CSV and JSON exports."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def write_table_csv(
    rows: DataFrame, path: str, headers: Mapping[str, str] | None = None, mode: str = "append"
) -> None:
    """One folder per date (``date=YYYY-MM-DD``) of CSV files with a header row.

    ``headers`` maps column names to header cells; columns keep their order.
    """
    named = rows.select(
        "date", *[F.col(f"`{c}`").alias((headers or {}).get(c, c)) for c in rows.columns if c != "date"]
    )
    named.hint("rebalance", "date").write.mode(mode).partitionBy("date").option("header", True).option(
        "escape", '"'
    ).csv(path)


def to_json_document(records: DataFrame, source: str, at: datetime, record: str = "record") -> DataFrame:
    """The lines of one JSON document: a listing with its source, time, size and records, in order.

    (part, json, i, line), to be read in the order of the first three: part 0 opens the document,
    part 1 has a line per record, sorted by its JSON text, and part 2 closes it. Only equal records are grouped, with map-side combine,
    and their copies are dealt out again as rows; no step holds the listing in one row.
    """
    texts = records.groupBy(F.to_json(record).alias("json")).agg(F.count(F.lit(1)).alias("n"))
    total = texts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    info = F.to_json(
        F.struct(
            F.lit(source).alias("source_url"),
            F.lit(at.isoformat()).alias("scraped_at"),
            F.col("total").alias("total_companies"),
        )
    )
    opening = F.concat(F.lit('{"scraping_info":'), info, F.lit(',"companies":['))
    frame = total.select(
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("part"), opening.alias("line")),
                F.struct(F.lit(2).alias("part"), F.lit("]}").alias("line")),
            )
        ).alias("e")
    ).select("e.part", F.lit("").alias("json"), F.lit(0).cast("bigint").alias("i"), "e.line")
    each = texts.withColumn("i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    # Every record but the first of all has a comma before it.
    first = (F.col("json") == texts.agg(F.min("json")).scalar()) & (F.col("i") == 1)
    comma = F.when(first, "").otherwise(",")
    body = each.select(F.lit(1).alias("part"), "json", "i", F.concat(comma, "json").alias("line"))
    return frame.unionByName(body)


def write_json_document(
    records: DataFrame, path: str, source: str, at: datetime, record: str = "record", mode: str = "error"
) -> None:
    """The document of ``to_json_document`` as text files that, read in name order, make it up."""
    lines = to_json_document(records, source, at, record)
    lines.orderBy("part", "json", "i").select("line").write.mode(mode).text(path)


def write_json_lines(records: DataFrame, path: str, mode: str = "append") -> None:
    records.write.mode(mode).json(path)
