"""Stages of column expressions over one DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


class Stages:
    """Each stage adds named SQL expressions that may use the columns of earlier stages."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.have = set(df.columns)

    def add(self, columns: Mapping[str, str]) -> None:
        """Add the columns that are not there yet; equal names mean equal definitions."""
        new = {name: sql for name, sql in columns.items() if name not in self.have}
        if new:
            self.have |= set(new)
            self.df = self.df.selectExpr("*", *[f"{sql} AS `{name}`" for name, sql in new.items()])
