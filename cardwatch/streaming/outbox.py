"""Alerts to a message sink behind an outbox, so that a failed sink loses and doubles nothing.

A micro-batch writes its alerts into the outbox folder of its id, next to the scored rows, from one read of the source;
a repeated batch replaces its folder. Delivery is a step of its own: batches that the ledger does not name are handed
to the sink in order, and named after the sink has taken them. Where a sink can tell which messages it has, a batch
that failed half-way is completed with the rest; every message carries an id made of its batch, key and content.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.sources import writers
from cardwatch.streaming.source import ARRIVAL

BATCH, MESSAGE_ID = "batch_id", "message_id"
MESSAGES = T.StructType([T.StructField(MESSAGE_ID, T.StringType()), T.StructField("key", T.StringType()),
                         T.StructField("value", T.StringType()), T.StructField(BATCH, T.LongType())])

#: Takes the messages of one batch and its id.
Send = Callable[[DataFrame, int], None]
#: Gives the ids (message_id) of the messages of a batch that the sink has already.
Received = Callable[[int], DataFrame]


def put(alerts: DataFrame, outbox: str, batch_id: int) -> None:
    """Stores the alerts of a batch as messages; a repetition replaces them."""
    messages = writers.alert_messages(alerts, ARRIVAL).select(F.col("key").cast("string"), F.col("value").cast("string"))
    named = F.sha2(F.concat_ws("|", F.lit(str(batch_id)), F.coalesce("key", F.lit("")), "value"), 256)
    messages.withColumn(MESSAGE_ID, named).dropDuplicates([MESSAGE_ID]).write.mode("overwrite").parquet(
        f"{outbox}/{BATCH}={batch_id}")


def delivered_upto(spark: SparkSession, ledger: str) -> int:
    first = spark.createDataFrame([(-1,)], f"{BATCH} bigint")
    first.write.mode("ignore").parquet(ledger)
    return spark.read.schema(first.schema).parquet(ledger).agg(F.max(BATCH)).first()[0]


def deliver(spark: SparkSession, outbox: str, ledger: str, send: Send, received: Received | None = None) -> int:
    """Hands on all batches not delivered yet, oldest first, and returns how many; an error of the sink is passed on.

    Without ``received`` a batch that failed half-way is sent whole once more.
    """
    upto = delivered_upto(spark, ledger)
    waiting = spark.read.schema(MESSAGES).parquet(outbox).where(F.col(BATCH) > upto)
    # one id for each micro-batch since the last delivery
    batches = sorted(r[0] for r in waiting.select(BATCH).distinct().collect())
    for batch_id in batches:
        messages = waiting.where(F.col(BATCH) == batch_id).drop(BATCH)
        if received is not None:
            messages = messages.join(received(batch_id).select(MESSAGE_ID).distinct(), MESSAGE_ID, "left_anti")
        send(messages, batch_id)
        spark.createDataFrame([(batch_id,)], f"{BATCH} bigint").write.mode("append").parquet(ledger)
    return len(batches)


def to_folder(path: str) -> tuple[Send, Received]:
    """A sink that appends messages to a folder, and what it has; for tests and for a second consumer of the alerts."""
    def send(messages: DataFrame, batch_id: int) -> None:
        messages.withColumn(BATCH, F.lit(batch_id).cast("bigint")).write.mode("append").parquet(path)

    def received(batch_id: int) -> DataFrame:
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([], MESSAGES).write.mode("ignore").parquet(path)
        return spark.read.schema(MESSAGES).parquet(path).where(F.col(BATCH) == batch_id)

    return send, received


def to_broker(servers: str, topic: str, **options: str) -> Send:
    """A topic of a message broker; the message id travels as a header, so consumers can tell repetitions."""
    def send(messages: DataFrame, batch_id: int) -> None:
        header = F.array(F.struct(F.lit(MESSAGE_ID).alias("key"), F.col(MESSAGE_ID).cast("binary").alias("value")))
        (messages.select("key", "value", header.alias("headers")).write.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("topic", topic).options(**options).save())

    return send
