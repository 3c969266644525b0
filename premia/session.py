"""Session settings and shared scratch space."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. All of them can be changed at run time, so they also apply to a
# session somebody else created.
#  - forceOptimizeSkewedJoin: a hot key in a shuffle join is split even if that costs a shuffle
#    further down.
#  - requireAllClusterKeysForDistribution: grouping by (product, size) after a join on product is
#    shuffled on both columns; otherwise a hot product would stay in one task.
#  - partitionColumnTypeInference: a brand named 007 stays a text.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "premia", master: str | None = None, **conf: str) -> SparkSession:
    """A tuned session; ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path for intermediate tables, below a folder all executors share.

    The folder is the session's ``spark.checkpoint.dir``, else the context's checkpoint folder, else a
    folder below the session's warehouse. What is written there is removed when the session's JVM ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    at, files = file_system(spark, path)
    files.deleteOnExit(at)
    return path


def release(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that no later step reads."""
    at, files = file_system(spark, path)
    files.delete(at, True)


def file_system(spark: SparkSession, path: str):
    """A path as the file system's own object, and that file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


# Spark removes the shuffle files of a query when it ends, not when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(frame, purpose: str):
    """Write a frame to shared scratch space and read it back: cuts lineage, survives lost executors.

    The shuffle files of the write are removed as soon as it is done; other queries keep the session's own setting.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, purpose)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)
