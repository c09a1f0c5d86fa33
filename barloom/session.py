"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Frees a query's shuffle files when the query ends.
_FREE_SHUFFLES_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("barloom")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Wide window projections exceed the size the JVM compiles; below this limit Spark
        # splits them into small methods instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # A plan of all indicators has more generated classes than the default cache of 100
        # holds, so that every task would compile them again.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such a
    folder would exist on one machine, so the setting is required there.
    """
    folder = spark.conf.get(_CHECKPOINT_KEY, None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="barloom-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str = "table", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a file read and not a recomputation,
    and lets later scans prune columns. Once the table is written nothing reads the shuffle files
    behind it, so they are freed at once and do not add up over the steps of a job.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    before = spark.conf.get(_FREE_SHUFFLES_KEY, None)
    spark.conf.set(_FREE_SHUFFLES_KEY, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES_KEY, before) if before else spark.conf.unset(_FREE_SHUFFLES_KEY)
    return spark.read.schema(df.schema).parquet(path)
