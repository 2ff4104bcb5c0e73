"""Streaming jobs: score, store, alert, join with profiles, read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from cardwatch.functions import rules, times
from cardwatch.operators import profiles, shape
from cardwatch.sources import writers
from cardwatch.streaming import outbox
from cardwatch.streaming.source import ARRIVAL

# Trigger intervals of the jobs.
STORE_EVERY, ALERT_EVERY, CLOUD_EVERY, METRICS_EVERY = "10 seconds", "5 seconds", "30 seconds", "60 seconds"


def score(transactions: DataFrame, by_arrival: bool = True, **limits: float) -> DataFrame:
    """Row-local enrichment, rules and reasons; the hour is the arrival hour by default."""
    time = F.col(ARRIVAL) if by_arrival else None
    scored = rules.apply(shape.enrich(transactions, time=time), rules.stream_rules(**limits))
    return scored.withColumns({"alert_reasons": profiles.alert_reasons(limits.get("max_amount", 5000)),
                               "transaction_date": times.event_date()})


def score_cloud(transactions: DataFrame) -> DataFrame:
    scored = rules.apply(shape.enrich_balance(transactions), rules.CLOUD)
    return scored.withColumns({"alert_reasons": profiles.alert_reasons(), "transaction_date": times.event_date()})


def _start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    """``every=None`` processes what is there and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def to_parquet(df: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ("risk_level",),
               every: str | None = STORE_EVERY) -> StreamingQuery:
    """Append to partitioned Parquet; the file sink's log makes it exactly-once."""
    writer = df.writeStream.format("parquet").option("path", path).partitionBy(*partition_by).outputMode("append")
    return _start(writer, checkpoint, every)


def to_messages(alerts: DataFrame, checkpoint: str, sink: str = "kafka", every: str | None = ALERT_EVERY,
                **options: str) -> StreamingQuery:
    """Alerts as JSON messages keyed by transaction."""
    messages = writers.alert_messages(alerts, ARRIVAL)
    return _start(messages.writeStream.format(sink).options(**options).outputMode("append"), checkpoint, every)


def to_console(df: DataFrame, mode: str = "update", every: str = METRICS_EVERY) -> StreamingQuery:
    return (df.writeStream.format("console").option("truncate", False).outputMode(mode)
            .trigger(processingTime=every).start())


def to_memory(df: DataFrame, name: str, mode: str = "append", every: str | None = METRICS_EVERY,
              checkpoint: str | None = None) -> StreamingQuery:
    writer = df.writeStream.format("memory").queryName(name).outputMode(mode)
    if checkpoint:
        return _start(writer, checkpoint, every)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def store_and_alert(scored_path: str, alerts_path: str, ledger: str | None = None, send: outbox.Send | None = None,
                    received: outbox.Received | None = None) -> Callable[[DataFrame, int], None]:
    """One pass per micro-batch into both sinks.

    Each batch owns the folder of its id and replaces it when it is repeated
    after a failure, so both sinks hold every row once. With ``send`` the alerts
    folder is an outbox, from which all batches that wait are handed on.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            keys = ["risk_level", "transaction_date"]
            (writers.balanced(kept, keys).write.mode("overwrite").partitionBy(*keys)
             .parquet(f"{scored_path}/batch_id={batch_id}"))
            outbox.put(shape.alerts_only(kept), alerts_path, batch_id)
            if send:
                outbox.deliver(batch.sparkSession, alerts_path, ledger or f"{alerts_path}_delivered", send, received)
        finally:
            kept.unpersist()

    return write


def run_pipeline(transactions: DataFrame, scored_path: str, alerts_path: str, checkpoint: str,
                 every: str | None = STORE_EVERY, cloud: bool = False, ledger: str | None = None,
                 send: outbox.Send | None = None, received: outbox.Received | None = None) -> StreamingQuery:
    """Transactions -> score -> all rows and alerts, from a single read of the source; ``send`` takes the alerts on."""
    scored = score_cloud(transactions) if cloud else score(transactions)
    store = store_and_alert(scored_path, alerts_path, ledger, send, received)
    writer = scored.writeStream.foreachBatch(store).outputMode("append")
    return _start(writer, checkpoint, every)


def with_profiles(scored: DataFrame, basics: DataFrame) -> DataFrame:
    """Stream joined with the static profiles, score adjusted afterwards."""
    return profiles.adjust_score(scored, basics)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/batch_id=*")


def batch_counts(stored: DataFrame) -> DataFrame:
    """Rows, predictions and labelled frauds per micro-batch."""
    return stored.groupBy("batch_id").agg(F.count("*").alias("transactions"),
                                          F.coalesce(F.count_if("is_fraud_predicted"), F.lit(0)).alias("predicted"),
                                          F.coalesce(F.count_if("is_fraud"), F.lit(0)).alias("frauds"))
