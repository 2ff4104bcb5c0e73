"""Message sources and parsing. Every source is a streaming frame; the connector is a parameter."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.operators.shape import normalize
from cardwatch.schemas import CLOUD_MESSAGE, STREAM_MESSAGE

ARRIVAL = "arrival_time"
WATERMARK = "10 minutes"
UNREADABLE = "_unreadable"


def read_broker(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                per_trigger: int | None = 1_000_000, fail_on_data_loss: bool = True, **options: str) -> DataFrame:
    """Topic of a message broker with the Kafka protocol; lost offsets end the query unless told otherwise."""
    if per_trigger:
        options = {"maxOffsetsPerTrigger": str(per_trigger), **options}
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .option("startingOffsets", starting).option("failOnDataLoss", str(fail_on_data_loss).lower())
            .options(**options).load())


def event_hub_options(connection: str, group: str = "$Default", offset: str = "-1") -> dict[str, str]:
    """Options of the event-hub connector: connection, consumer group, starting position."""
    position = {"offset": offset, "seqNo": -1, "enqueuedTime": None, "isInclusive": True}
    return {"eventhubs.connectionString": connection, "eventhubs.consumerGroup": group,
            "eventhubs.startingPosition": json.dumps(position)}


def read_event_hub(spark: SparkSession, **options: str) -> DataFrame:
    return spark.readStream.format("eventhubs").options(**options).load()


def read_folder(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet",
                files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Files of a folder, in order of arrival."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).load(path)


def parse(messages: DataFrame, schema: T.StructType = STREAM_MESSAGE, body: str = "value",
          arrival: str | Column = "timestamp", watermark: str = WATERMARK, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON bodies to canonical columns, with the arrival time as watermark column.

    ``withWatermark`` needs TIMESTAMP, so zone-less times are cast. Bodies that are no JSON are left to ``rejects``.
    """
    arrived = F.col(arrival) if isinstance(arrival, str) else arrival
    parsed = messages.select(arrived.cast("timestamp").alias(ARRIVAL), *keep, _read(F.col(body), schema).alias("_t"))
    readable = parsed.where(~_unreadable()).select(ARRIVAL, *keep, "_t.*").drop(UNREADABLE)
    return normalize(readable).withWatermark(ARRIVAL, watermark)


def rejects(messages: DataFrame, schema: T.StructType = STREAM_MESSAGE, body: str = "value",
            arrival: str | Column = "timestamp") -> DataFrame:
    """Arrival time and raw text of the messages that ``parse`` leaves out."""
    arrived = F.col(arrival) if isinstance(arrival, str) else arrival
    raw = messages.select(arrived.cast("timestamp").alias(ARRIVAL), F.col(body).cast("string").alias("raw"),
                          _read(F.col(body), schema).alias("_t"))
    return raw.where(_unreadable()).select(ARRIVAL, "raw")


def _read(body: Column, schema: T.StructType) -> Column:
    wider = T.StructType([*schema.fields, T.StructField(UNREADABLE, T.StringType())])
    return F.from_json(body.cast("string"), wider, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE})


def _unreadable() -> Column:
    return F.col("_t").isNull() | F.col(f"_t.{UNREADABLE}").isNotNull()


def parse_event_hub(messages: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    named = messages.withColumnRenamed("partition", "partitionId")
    return parse(named, CLOUD_MESSAGE, "body", "enqueuedTime", watermark, keep=("offset", "partitionId"))


def to_messages(df: DataFrame, arrival: Column | None = None) -> DataFrame:
    """Transactions as (key, value, timestamp) messages under the input field names."""
    from cardwatch.schemas import FIELD_NAMES
    fields = [F.col(b).alias(a) for a, b in FIELD_NAMES.items() if b in df.columns and b != "is_fraud"]
    when = F.timestamp_millis("timestamp_ms") if arrival is None else arrival
    return df.select(F.col("transaction_id").alias("key"), F.to_json(F.struct(*fields)).alias("value"),
                     when.alias("timestamp"))
