"""Intermediate tables in the shared folder, and row numbers without a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.session import fresh_path

WHILE_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # rows can hold a whole set or text; a task's Python worker gets so many bytes of them at a time
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    Lost executors cost only the stages of this write. The shuffle files of the write go as soon as it ends,
    so several steps in a row need the disk of the largest one only.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    before = {key: spark.conf.get(key, None) for key in WHILE_WRITING}
    for key, value in WHILE_WRITING.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that no later step reads, so that disk use does not add up over the steps."""
    for table in tables:
        spark = table.sparkSession
        for place in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folder(spark: SparkSession, label: str) -> str:
    return fresh_path(spark, label)


def numbered(df: DataFrame, order: Column, name: str, label: str = "numbered") -> DataFrame:
    """Adds the row's number from 0 in the given total order.

    Rows are sorted by range and numbered inside each partition; only one row per partition is put in one place.
    """
    ordered = staged(df.orderBy(order).withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = sizes.select("_part", F.expr("coalesce(sum(_n) over (order by _part rows between unbounded preceding "
                                           "and 1 preceding), 0L)").alias("_earlier"))
    return (ordered.withColumn("_part", part).join(F.broadcast(earlier), "_part")
            .withColumn(name, F.col("_earlier") + F.col("_at") - F.shiftleft("_part", 33))
            .drop("_part", "_at", "_earlier"))


def fields(df: DataFrame, **kinds: T.DataType) -> T.StructType:
    """The schema of the frame without clashing names, then the given columns."""
    return T.StructType([f for f in df.schema if f.name not in kinds]
                        + [T.StructField(name, kind) for name, kind in kinds.items()])
