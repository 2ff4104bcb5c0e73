"""Complete results of a stream in update mode, kept as versions of the rows that changed.

In update mode a query hands on the windows that a micro-batch changed, so a window comes again and again until it is
closed. Each batch is stored in a folder of its own, which it replaces when it is repeated after a failure; of each key
the version of the latest batch counts. ``compact`` writes the latest versions once, so that reading does not depend on
the number of batches; a compaction is used only after its mark, so a failed one changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

VERSION = "batch_id"


def write_versions(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Stores what each micro-batch changed; ``every=None`` processes what is there and stops."""
    nothing = df.sparkSession.createDataFrame([], df.schema)
    nothing.write.mode("ignore").parquet(f"{path}/versions/{VERSION}=-1")

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/versions/{VERSION}={batch_id}")

    writer = df.writeStream.foreachBatch(store).outputMode("update").option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def latest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The last version of each row."""
    upto = _compacted(spark, path)
    rows = _versions(spark, path, schema).where(F.col(VERSION) > upto)
    if upto >= 0:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{path}/compact/upto={upto}")
                                .withColumn(VERSION, F.lit(upto).cast("bigint")))
    return _last(rows, schema, keys)


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], upto: int) -> None:
    """Writes the last versions up to and including a finished batch; older folders are no longer read."""
    before = _compacted(spark, path)
    if upto <= before:
        return
    rows = _versions(spark, path, schema).where((F.col(VERSION) > before) & (F.col(VERSION) <= upto))
    if before >= 0:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{path}/compact/upto={before}")
                                .withColumn(VERSION, F.lit(before).cast("bigint")))
    _last(rows, schema, keys).write.mode("overwrite").parquet(f"{path}/compact/upto={upto}")
    spark.createDataFrame([(upto,)], "upto bigint").write.mode("append").parquet(f"{path}/marks")


def _versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    wider = T.StructType([*schema.fields, T.StructField(VERSION, T.LongType())])
    return spark.read.schema(wider).parquet(f"{path}/versions")


def _last(rows: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    values = F.struct(*[c for c in schema.names if c not in keys])
    newest = rows.groupBy(*keys).agg(F.max_by(values, VERSION).alias("_row"))
    return newest.select(*keys, "_row.*").select(*schema.names)


def _compacted(spark: SparkSession, path: str) -> int:
    """The last batch that a finished compaction holds, or -1."""
    marks = spark.createDataFrame([(-1,)], "upto bigint")
    marks.write.mode("ignore").parquet(f"{path}/marks")
    return spark.read.schema(marks.schema).parquet(f"{path}/marks").agg(F.max("upto")).first()[0]
