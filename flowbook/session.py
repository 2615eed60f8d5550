"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the jobs rely on.  ANSI is Spark 4's default and is stated because the
# operators use the try_* functions where dirty input must become null instead of
# failing; AQE splits skewed join partitions and sizes the shuffles.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot partitions also where the next join reuses the key's partitioning (chains of lookups on one key).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A plan of the monthly base has more generated classes than the default cache of 100.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # No Python call-site lookup for each column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "flowbook", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the defaults above; ``settings`` (``_`` for ``.``) win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def _root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; where a local session has none, one below the JVM's folder is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        temporary = spark._jvm.java.lang.System.getProperty("java.io.tmpdir")
        root = f"{temporary.rstrip('/')}/flowbook-work"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for an intermediate table, below the session's own part of the shared folder."""
    return f"{_root(spark)}/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_working_folder(spark: SparkSession) -> None:
    """Delete this session's intermediate tables; frames that read them can no longer run."""
    remove_folder(spark, f"{_root(spark)}/{spark.sparkContext.applicationId}")


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when each write ends: its rows are stored, and nothing reads those files again.

    Without it they stay on disk until the driver happens to collect garbage, beside the shuffles of the jobs that follow.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def computed_once(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the working folder and read back.

    For a frame that several branches of a plan need: its sources are scanned once, the
    branches prune the columns they read, and a lost executor repeats a branch, not the scan.
    """
    folder = working_folder(df.sparkSession, purpose)
    with shuffles_released(df.sparkSession):
        df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def code_cut(df: DataFrame) -> DataFrame:
    """The same rows, past an operator without generated code.

    Spark makes one function of a chain of joins and projections, and the JVM does not compile a function of more than
    8,000 bytes.  A long chain over wide rows runs several times faster as two functions below that.
    """
    return df.observe(f"rows-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))
