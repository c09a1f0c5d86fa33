"""Files as rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files up to this size are one value of a row, larger ones are read piece by piece.
WHOLE_BYTES = 64 << 20
_PIECE_BYTES = 8 << 20


def _open(path: str):
    """A stream of a file's bytes in a store that pyarrow reaches: local paths, HDFS, object stores."""
    local = path.removeprefix("file:")
    if local.startswith("/"):
        return fs.LocalFileSystem().open_input_stream("/" + local.lstrip("/"))
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_stream(name)


def _md5_in_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        digests = []
        for path in batch["file"]:
            digest = hashlib.md5()
            with _open(path) as stream:
                while piece := stream.read(_PIECE_BYTES):
                    digest.update(piece)
            digests.append(digest.hexdigest())
        yield batch.assign(md5=digests)


def file_hash(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """MD5 of each file's bytes: (file, bytes, md5).

    Files of up to WHOLE_BYTES are read and hashed by Spark, in any store. Larger ones are dealt out one by
    one and read in pieces, so their size has no bound; that takes a store that pyarrow reaches.
    The condition on the length is applied to the listing: no file is read by both. Empty files are left
    out, as Spark's readers skip them.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    small = files.where(F.col("length") <= WHOLE_BYTES).select(
        F.col("path").alias("file"), F.col("length").alias("bytes"), F.md5("content").alias("md5")
    )
    large = files.where(F.col("length") > WHOLE_BYTES).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    hashed = large.repartition(F.col("file")).mapInPandas(_md5_in_pieces, "file string, bytes bigint, md5 string")
    return small.unionByName(hashed)
