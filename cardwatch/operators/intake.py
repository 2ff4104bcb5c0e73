"""Input files that no run has read yet, by a ledger of files that survives lost runs.

A run claims the files that are in the folder and in no earlier claim, and reads exactly these, however often it is
repeated: the claim is written before any row is read. A file is known by its path, time and length, so a file that was
written anew counts as a new arrival. A claim takes effect with its mark; a claim that was lost half-way is made again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A claim of up to so many files is read by their names; a longer one by a join with the rows' file names.
FEW_FILES = 10_000
FILE = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                     T.StructField("length", T.LongType())])
RUN = T.StructType([T.StructField("run", T.StringType())])


def files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, modificationTime, length) of the files below a folder; their content is not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
            .load(folder).select(*FILE.names))


def claim(spark: SparkSession, folder: str, ledger: str, run: str, pattern: str = "*.parquet") -> DataFrame:
    """The files of a run: those claimed at its first attempt, else all that no other run has claimed."""
    _create(spark, ledger)
    own = f"{ledger}/claims/run={run}"
    if not _marked(spark, ledger).where(F.col("run") == run).isEmpty():
        return spark.read.schema(FILE).parquet(own)
    taken = _claims(spark, ledger).join(_marked(spark, ledger), "run", "left_semi").select(*FILE.names)
    files(spark, folder, pattern).join(taken, FILE.names, "left_anti").write.mode("overwrite").parquet(own)
    spark.createDataFrame([(run,)], RUN).write.mode("append").parquet(f"{ledger}/marks")
    return spark.read.schema(FILE).parquet(own)


def read_claimed(spark: SparkSession, folder: str, claimed: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of the claimed Parquet files only."""
    few = [r[0] for r in claimed.select("path").limit(FEW_FILES + 1).collect()]
    if not few:
        return spark.createDataFrame([], schema)
    if len(few) <= FEW_FILES:
        return spark.read.schema(schema).parquet(*few)
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
    named = claimed.select(F.col("path").alias("_path"))
    return rows.withColumn("_path", F.col("_metadata.file_path")).join(named.hint("merge"), "_path", "left_semi").drop("_path")


def _create(spark: SparkSession, ledger: str) -> None:
    spark.createDataFrame([], RUN).write.mode("ignore").parquet(f"{ledger}/marks")
    spark.createDataFrame([], FILE).write.mode("ignore").parquet(f"{ledger}/claims/run=none")


def _marked(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(RUN).parquet(f"{ledger}/marks")


def _claims(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(T.StructType([*FILE, *RUN])).parquet(f"{ledger}/claims")
