"""Published top-ten reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.clean import parse_number, strip
from barloom.sources.csv_files import read_cells


def read_top10_report(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Ranked rows of report files: (file, rank, security_name, symbol, value).

    The letterhead, the header row and blank filler columns vary between years, but a ranked
    row always starts with its number, followed by name, symbol and value.
    """
    trimmed = F.transform("cells", lambda c: strip(c))
    filled = F.filter(trimmed, lambda c: c.isNotNull() & (c != ""))
    rows = read_cells(spark, path).select("file", filled.alias("cells"))
    ranked = rows.where("size(cells) >= 4 AND cells[0] RLIKE '^[0-9]+$'")
    return ranked.select(
        "file",
        F.col("cells")[0].cast("int").alias("rank"),
        F.col("cells")[1].alias("security_name"),
        F.col("cells")[2].alias("symbol"),
        parse_number(F.col("cells")[3]).alias("value"),
    )
