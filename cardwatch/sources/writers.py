"""Sinks and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.schemas import PARTITIONS, WAREHOUSE


def balanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of one output partition together, in tasks of even size.

    Adaptive execution merges small and splits large shuffle partitions, so a
    level that holds most rows is written by many tasks and a rare one by one.
    """
    return df.hint("rebalance", *columns) if columns else df.hint("rebalance")


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ("is_fraud",),
                  mode: str = "overwrite") -> None:
    """Partitioned Parquet."""
    balanced(df, list(partition_by)).write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_scored(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The scored table, partitioned by risk level and date."""
    write_parquet(df, path, PARTITIONS["transactions"], mode)


def write_table(df: DataFrame, name: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """Catalog table with data at an external path."""
    writer = balanced(df, list(partition_by)).write.mode("overwrite").format("parquet").option("path", path)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def suspicious_lines(df: DataFrame) -> DataFrame:
    """``id,customer,amount,reason;reason`` per suspicious row."""
    return df.select(F.concat_ws(",", "transaction_id", "customer_id", F.col("amount").cast("string"),
                                 F.array_join("reasons", ";")).alias("value"))


def write_suspicious(df: DataFrame, path: str) -> None:
    suspicious_lines(df).write.mode("overwrite").text(path)


def publish_view(df: DataFrame, name: str = "transactions", shared: bool = False) -> None:
    """Temp view of the session, or of the application (``global_temp.name``)."""
    if shared:
        df.createOrReplaceGlobalTempView(name)
    else:
        df.createOrReplaceTempView(name)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def create_table(spark: SparkSession, name: str, path: str, schema: T.StructType,
                 partition_by: Sequence[str] = ()) -> None:
    """External Parquet table over a path; the partitions found there are added."""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING parquet{parts} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def create_warehouse(spark: SparkSession, base_path: str, prefix: str = "") -> None:
    """The six warehouse tables below a base path."""
    for name, schema in WAREHOUSE.items():
        create_table(spark, prefix + name, f"{base_path}/{name}", schema, PARTITIONS.get(name, ()))


def by_customer(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Hash partitioned by customer.

    With a fixed number all rows of a customer share a partition; without one,
    adaptive execution sizes the partitions and splits a customer that is too large for one.
    """
    return df.repartition(partitions, "customer_id") if partitions else balanced(df, ["customer_id"])


def fewer_partitions(df: DataFrame, partitions: int) -> DataFrame:
    return df.coalesce(partitions)


def alert_messages(alerts: DataFrame, processed_at: str = "processed_at") -> DataFrame:
    """Key and JSON value of each alert, for any sink that takes messages."""
    return alerts.select(
        F.col("transaction_id").alias("key"),
        F.to_json(F.struct("transaction_id", "customer_id", "amount", "fraud_score", "risk_level", "alert_reasons",
                           F.col(processed_at).alias("processed_at"))).alias("value"))


def write_messages(messages: DataFrame, sink: str = "kafka", **options: str) -> None:
    """Batch write to a message sink, by the executors."""
    messages.write.format(sink).options(**options).mode("append").save()
