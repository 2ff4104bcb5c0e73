"""Session settings the jobs rely on, and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings, safe to set on a session somebody else created.
RUNTIME = {
    # Hours, dates and windows are defined in UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A join whose key holds a large share of the rows is split at run time,
    # also when that costs one more exchange for the aggregate behind it.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows of one session are merged before the shuffle, so a busy customer
    # sends sessions and not rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(name: str = "cardwatch", master: str | None = None, shuffle_partitions: int | None = None,
                  **extra: str) -> SparkSession:
    """A session for scripts and tests; on a cluster ``master`` comes from spark-submit."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    # Call-site capture costs several JVM calls per column expression.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    for key, value in {**RUNTIME, **extra}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``; where it is unset, a folder of the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(spark: SparkSession, df: DataFrame, label: str = "stage") -> DataFrame:
    """The frame written once to the shared folder and read back.

    For results that several jobs use: they survive lost executors and are not computed again.
    """
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
