"""Connected components by alternating large and small stars, on written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import written


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Per node the smallest of itself and its neighbours (``a`` to ``b``)."""
    return edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """One row per node of an edge: ``node``, ``component`` (its least node).

    Each round links every node's larger neighbours, then its smaller ones, to the least of them;
    edges only shrink towards stars, in a number of rounds logarithmic in the longest path. Rounds
    are written to the shared folder, so a lost executor costs a read. Null ends are left out. No
    edges: no rows. A node with many edges is combined before the shuffle, and its join partition
    is split at run time.
    """
    now = written(
        edges.select(F.col(left).cast("bigint").alias("a"), F.col(right).cast("bigint").alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_least_neighbour(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a <> b").distinct(), "edges")
        small = large.join(_least_neighbour(large), "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        now = written(small.where("a <> b").distinct(), "edges")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
