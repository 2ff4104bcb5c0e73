"""Streaming jobs over the events as a file stream; each run processes what is there and returns what was written."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions import times
from cardwatch.operators import dashboards, profiles
from cardwatch.plans.catalog import history_of, query, scored, tx
from cardwatch.plans.row_queries import CLOUD_POINTS, CODES
from cardwatch.plans.sql import DATE, FRAUDS, HISTORY, HITS, MEAN, N, SCORE, TOTAL, flags, rate
from cardwatch.session import fresh_path, staged, tune
from cardwatch.sources import tables
from cardwatch.streaming import outbox, pipeline, sessions, source, upsert, windows
from cardwatch.streaming.source import ARRIVAL

# Sessions still open when the watermark stops ten minutes before the last event are not emitted.
CLOSED = "<= (SELECT MAX(timestamp_ms) FROM tx) - 600000"


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a stream of JSON messages."""
    tune(spark)
    schema = tables.table(spark, sf, "events").schema
    # A glob, so that the table may be one file or a folder of files.
    events = source.read_folder(spark, f"{sf}/events.{{parquet}}", schema)
    return source.to_messages(tables.from_events(events))


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    return source.parse(messages(spark, sf))


def written(spark: SparkSession, df: DataFrame, mode: str = "append") -> DataFrame:
    """Runs the stream to the end of the input and reads its output."""
    path = fresh_path(spark, "stream")
    query_ = df.writeStream.format("parquet").option("path", path).outputMode(mode)
    pipeline._start(query_, fresh_path(spark, "progress"), None).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def complete(spark: SparkSession, df: DataFrame, keys: list[str]) -> DataFrame:
    """Runs the stream in update mode and reads the last version of every row, open windows included."""
    path = fresh_path(spark, "versions")
    upsert.write_versions(df, path, fresh_path(spark, "progress")).awaitTermination()
    return upsert.latest(spark, path, df.schema, keys)


def run(spark: SparkSession, sf: str, cloud: bool = False) -> tuple[str, str]:
    stored, alerts = fresh_path(spark, "stored"), fresh_path(spark, "alerts")
    rows = transactions(spark, sf)
    pipeline.run_pipeline(rows, stored, alerts, fresh_path(spark, "progress"), None, cloud).awaitTermination()
    return stored, alerts


def timed(df: DataFrame) -> DataFrame:
    return df.withColumn(ARRIVAL, times.event_time())


@query("stream_scored_store", f"""SELECT transaction_id, amount, score_points, risk_level, is_fraud_predicted,
    {CODES} AS alert_reasons, CAST({DATE} AS VARCHAR) AS transaction_date FROM scored""")
def _(spark, sf):
    return pipeline.read_back(spark, run(spark, sf)[0]).select(
        "transaction_id", "amount", "score_points", "risk_level", "is_fraud_predicted", "alert_reasons",
        "transaction_date")


@query("stream_alerts", "SELECT transaction_id AS key, risk_level FROM scored WHERE alert_required")
def _(spark, sf):
    alerts = pipeline.read_back(spark, run(spark, sf)[1])
    return alerts.select("key", F.get_json_object("value", "$.risk_level").alias("risk_level"))


@query("stream_alert_messages", "SELECT transaction_id AS key, risk_level FROM scored WHERE alert_required")
def _(spark, sf):
    """Alerts handed from the outbox to a message sink by the job that stores the scored rows."""
    sink, place = fresh_path(spark, "messages"), fresh_path(spark, "outbox")
    send, received = outbox.to_folder(sink)
    pipeline.run_pipeline(transactions(spark, sf), fresh_path(spark, "stored"), place, fresh_path(spark, "progress"), None,
                          send=send, received=received).awaitTermination()
    return spark.read.schema(outbox.MESSAGES).parquet(sink).select("key", F.get_json_object("value", "$.risk_level").alias("risk_level"))


@query("stream_batch_counts", f"SELECT {N} AS transactions, {HITS} AS predicted, {FRAUDS} AS frauds FROM scored")
def _(spark, sf):
    """Per micro-batch counts with the labels known by then, added up over the batches."""
    labels = tx(spark, sf).select("transaction_id", "is_fraud")
    stored = pipeline.read_back(spark, run(spark, sf)[0]).drop("is_fraud").join(labels, "transaction_id", "left")
    return pipeline.batch_counts(stored).agg(*[F.sum(c).alias(c) for c in ("transactions", "predicted", "frauds")])


@query("stream_read_back", f"""SELECT risk_level, {N} AS transaction_count FROM scored GROUP BY risk_level""")
def _(spark, sf):
    return dashboards.risk_distribution(pipeline.read_back(spark, run(spark, sf)[0]))


@query("stream_parquet_sink", f"""SELECT risk_level, CAST({DATE} AS VARCHAR) AS transaction_date, {N} AS transaction_count
    FROM scored GROUP BY 1, 2""")
def _(spark, sf):
    """The plain partitioned file sink."""
    path = fresh_path(spark, "sink")
    rows = pipeline.score(transactions(spark, sf))
    pipeline.to_parquet(rows, path, fresh_path(spark, "progress"), ("risk_level", "transaction_date"),
                        every=None).awaitTermination()
    return spark.read.parquet(path).groupBy("risk_level", "transaction_date").agg(
        F.count("*").alias("transaction_count"))


@query("stream_profile_join", f""", basics AS (SELECT customer_id, {MEAN} AS mean, MAX(amount) AS most,
      {FRAUDS} AS past FROM tx WHERE {HISTORY} GROUP BY customer_id)
    SELECT transaction_id, CAST(score_points + CASE WHEN amount > most THEN 20 WHEN (amount - mean) / mean > 2 THEN 15
      WHEN past > 0 THEN 10 ELSE 0 END AS DOUBLE) / 100 AS adjusted_fraud_score
    FROM scored LEFT JOIN basics USING (customer_id)""")
def _(spark, sf):
    basics = staged(spark, profiles.profile_basics(history_of(tx(spark, sf))), "profiles")  # once, not in every batch
    joined = pipeline.with_profiles(pipeline.score(transactions(spark, sf)), basics)
    return written(spark, joined.select("transaction_id", "adjusted_fraud_score"))


SLIDING = f"""SELECT customer_id, s AS window_start, s + 300000 AS window_end, {N} AS tx_count, {TOTAL} AS total_amount,
    {MEAN} AS avg_amount, MAX(amount) AS max_amount, string_agg(DISTINCT location, ';' ORDER BY location) AS locations,
    {N} > 10 AS is_velocity_anomaly, {TOTAL} > 10000 AS is_amount_anomaly,
    COUNT(DISTINCT location) > 3 AS is_multi_location_anomaly
    FROM (SELECT *, UNNEST([0, 1, 2, 3, 4]) AS k, timestamp_ms // 60000 * 60000 - k * 60000 AS s FROM tx)
    GROUP BY customer_id, s"""


@query("win_sliding", SLIDING)
def _(spark, sf):
    return windows.sliding(timed(tx(spark, sf)))


@query("win_sliding_anomalies", f"SELECT * FROM ({SLIDING}) WHERE is_velocity_anomaly OR is_amount_anomaly OR is_multi_location_anomaly")
def _(spark, sf):
    return windows.anomalies(windows.sliding(timed(tx(spark, sf))))


@query("win_sliding_stream", SLIDING)
def _(spark, sf):
    """Minutes are kept in the state of the stream, and windows put together from them when its versions are read."""
    found = complete(spark, windows.panes(transactions(spark, sf)), ["customer_id", "window_start", "window_end"])
    return windows.sliding_from_panes(found)


SESSION = """, marked AS (SELECT *, SUM(CASE WHEN timestamp_ms - p_ms <= 600000 THEN 0 ELSE 1 END) OVER (
      PARTITION BY customer_id ORDER BY timestamp_ms, transaction_id) AS session FROM seq
    ), sessions AS (SELECT customer_id, session, MIN(timestamp_ms) AS session_start,
      MAX(timestamp_ms) + 600000 AS session_end, COUNT(*) AS session_tx_count,
      CAST(SUM(amount_cents) AS DOUBLE) / 100 AS session_total_amount,
      arg_min(location, rn) AS first_location, arg_max(location, rn) AS last_location
      FROM marked GROUP BY customer_id, session)
    SELECT * EXCLUDE (session), first_location <> last_location AS has_location_change,
      CAST(session_end - session_start AS DOUBLE) / 60000 AS session_duration_minutes FROM sessions"""


@query("win_session", SESSION)
def _(spark, sf):
    return windows.sessions_batch(timed(tx(spark, sf))).drop("merchant_categories")


@query("win_session_categories", SESSION[:SESSION.index("SELECT * EXCLUDE")] + """SELECT m.customer_id, s.session_start,
    merchant_category AS category, COUNT(*) AS row_count FROM marked m JOIN sessions s USING (customer_id, session)
    GROUP BY 1, 2, 3""")
def _(spark, sf):
    out = windows.sessions_batch(timed(tx(spark, sf)))
    return out.select("customer_id", "session_start", F.explode("merchant_categories").alias("c")).select(
        "customer_id", "session_start", "c.category", "c.row_count")


@query("win_session_any_category", SESSION[:SESSION.index("SELECT * EXCLUDE")] + """SELECT m.customer_id, s.session_start,
    CASE WHEN timestamp_ms % 5 = 0 THEN NULL WHEN timestamp_ms % 5 = 1 THEN 'ATM' ELSE merchant_category END AS category,
    COUNT(*) AS row_count FROM marked m JOIN sessions s USING (customer_id, session) GROUP BY 1, 2, 3""")
def _(spark, sf):
    """Sessions over categories that no list names, and over missing ones."""
    kind = F.col("timestamp_ms") % 5
    rows = tx(spark, sf).withColumn("merchant_category", F.when(kind == 1, "ATM").when(kind != 0, F.col("merchant_category")))
    out = windows.sessions_batch(timed(rows))
    return out.select("customer_id", "session_start", F.explode("merchant_categories").alias("c")).select(
        "customer_id", "session_start", "c.category", "c.row_count")


@query("win_session_stream", SESSION + f" WHERE session_end {CLOSED}")
def _(spark, sf):
    return written(spark, windows.sessions(transactions(spark, sf)).drop("merchant_categories"))


@query("win_session_categories_stream", SESSION[:SESSION.index("SELECT * EXCLUDE")] + f"""SELECT m.customer_id,
    s.session_start, merchant_category AS category, COUNT(*) AS row_count
    FROM marked m JOIN sessions s USING (customer_id, session) WHERE session_end {CLOSED} GROUP BY 1, 2, 3""")
def _(spark, sf):
    """Closed sessions with their categories, from a state that holds one count per category."""
    out = written(spark, sessions.sessions(transactions(spark, sf)))
    return out.select("customer_id", "session_start", F.explode("merchant_categories").alias("c")).select(
        "customer_id", "session_start", "c.category", "c.row_count")


METRICS = f"""SELECT timestamp_ms // 60000 * 60000 AS window_start, window_start + 60000 AS window_end,
    {N} AS total_transactions, {TOTAL} AS total_volume, {MEAN} AS avg_amount, {HITS} AS fraud_count,
    COUNT(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical_count,
    COUNT(*) FILTER (WHERE risk_level = 'HIGH') AS high_risk_count, {SCORE} AS avg_fraud_score, {rate(HITS)} AS fraud_rate
    FROM scored GROUP BY 1"""


@query("win_tumbling_metrics", METRICS)
def _(spark, sf):
    return windows.metrics(timed(scored(spark, sf)))


@query("win_tumbling_metrics_stream", METRICS)
def _(spark, sf):
    return complete(spark, windows.metrics(pipeline.score(transactions(spark, sf))), ["window_start", "window_end"])


@query("stream_cloud_store", f"SELECT transaction_id, {flags(CLOUD_POINTS)} FROM enriched")
def _(spark, sf):
    """Second rule set: the balance comes with the message."""
    tune(spark)
    events = source.read_folder(spark, f"{sf}/events.{{parquet}}", tables.table(spark, sf, "events").schema)
    accounts = tables.table(spark, sf, "customer").selectExpr("c_custkey AS _user_id",
                                                              "greatest(c_acctbal, 0D) AS previous_balance")
    rows = source.parse(source.to_messages(tables.from_events(events).join(accounts, "_user_id", "left")))
    stored = fresh_path(spark, "stored")
    pipeline.run_pipeline(rows, stored, fresh_path(spark, "alerts"), fresh_path(spark, "progress"), None,
                          cloud=True).awaitTermination()
    return pipeline.read_back(spark, stored).select("transaction_id", "score_points", "fraud_score", "risk_level",
                                                    "is_fraud_predicted", "alert_required")


@query("event_hub_parse", """SELECT transaction_id, amount, 'p' AS partition_id, timestamp_ms AS arrival_time, location
    FROM tx""")
def _(spark, sf):
    """The envelope of the event-hub source: body, enqueued time, offset, partition."""
    envelope = source.to_messages(tx(spark, sf)).select(
        F.encode("value", "utf-8").alias("body"), F.col("timestamp").alias("enqueuedTime"),
        F.lit("0").alias("offset"), F.lit("p").alias("partition"))
    return source.parse_event_hub(envelope).select("transaction_id", "amount", F.col("partitionId").alias("partition_id"),
                                                   ARRIVAL, "location")
