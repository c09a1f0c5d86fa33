"""Daily CSV files of any width as rows of cells."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Mapping, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OPTIONS = {"wholetext": "true", "recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}


def parse_csv(text: str | None) -> list[list[str | None]]:
    """The rows of a CSV text, quotes and quoted line breaks resolved; empty cells are None."""
    csv.field_size_limit(1 << 30)
    rows = csv.reader(io.StringIO((text or "").removeprefix("﻿"), newline=""))
    return [[c or None for c in row] for row in rows if row]


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for file, modified, text in zip(batch["file"], batch["modified"], batch["value"]):
            rows = parse_csv(text)
            if not rows:  # an empty frame has no types
                continue
            yield pd.DataFrame({"file": [file] * len(rows), "modified": [modified] * len(rows), "cells": rows})


def cells_of(files: DataFrame) -> DataFrame:
    """Rows (file, modified, cells) of files given as (file, modified, value), as wide as the file has them.

    A daily file of a few megabytes is parsed by one call, since a quoted cell may hold line breaks
    and files differ in width; files spread over the tasks.
    """
    return files.select("file", "modified", "value").mapInPandas(
        _parse, "file string, modified bigint, cells array<string>"
    )


def _positions(rows: list[list[str | None]], marker: Sequence[str], names: Mapping[str, str]) -> tuple[dict[str, int], list]:
    """Where a file has its columns, by its rows with a ``marker`` cell, and its other rows."""
    headers, data = [], []
    for row in rows:
        trimmed = [(c or "").strip() for c in row]
        (headers if any(m in trimmed for m in marker) else data).append((row, trimmed))
    places: dict[str, int] = {}
    for _, trimmed in headers:
        own: dict[str, int] = {}
        for header, column in names.items():
            if header in trimmed:
                own.setdefault(column, trimmed.index(header))
        for column, place in own.items():
            places[column] = max(place, places.get(column, -1))
    return places, [row for row, _ in data] if headers else []


def columns_of(files: DataFrame, marker: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """Rows (file, modified, one text per column of ``names``) of files given as (file, modified, value).

    Columns are found by header name, file by file, while the file is parsed: a header is a row with
    a ``marker`` cell, ``names`` maps its cells to columns. A column that a file lacks is null, and a
    file without a header has no rows.
    """
    columns = list(dict.fromkeys(names.values()))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, modified, text in zip(batch["file"], batch["modified"], batch["value"]):
                places, rows = _positions(parse_csv(text), marker, names)
                if not rows:
                    continue
                out = {"file": [file] * len(rows), "modified": [modified] * len(rows)}
                for c in columns:
                    at = places.get(c, 1 << 30)
                    out[c] = pd.Series([row[at] if at < len(row) else None for row in rows], dtype=object)
                yield pd.DataFrame(out)

    texts = ", ".join(f"`{c}` string" for c in columns)
    return files.select("file", "modified", "value").mapInPandas(parse, f"file string, modified bigint, {texts}")


def _named(raw: DataFrame) -> DataFrame:
    # File paths are URL-encoded in the metadata column.
    file = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    modified = F.unix_micros("_metadata.file_modification_time")
    return raw.select(file.alias("file"), modified.alias("modified"), "value")


def read_files(spark: SparkSession, path: str | list[str], run_date: date | None = None) -> DataFrame:
    """Whole CSV files as (file, modified in microseconds, value).

    With ``run_date`` only files are opened whose path holds the date; the condition is on the path,
    so Spark applies it to the listing.
    """
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.format("text").options(**_OPTIONS).load(paths)
    if run_date is not None:
        y, m, d = f"{run_date.year:04d}", run_date.month, run_date.day
        forms = f"{y}[-_]0?{m}[-_]0?{d}(?![0-9])|{y}{m:02d}{d:02d}"
        raw = raw.where(F.col("_metadata.file_path").rlike(forms))
    return _named(raw)


def read_cells(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV rows as (file, modified, cells), every cell a string, with the header rows still in place."""
    return cells_of(read_files(spark, path))


def stream_files(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """Files that arrive below ``path`` as a stream of (file, modified, value)."""
    reader = spark.readStream.format("text").options(**_OPTIONS, maxFilesPerTrigger=str(files_per_batch))
    return _named(reader.load(path))
